"""spark-submit launcher for the daily run (see ``botpulse.plans.daily_run.main``).

    spark-submit --py-files botpulse.zip run_daily.py --inputs ... --out ... [--start D --end D]
"""

from botpulse.plans.daily_run import main

if __name__ == "__main__":
    raise SystemExit(main())
