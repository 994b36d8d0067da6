"""Chatbot engagement KPIs on Spark: click rate, chat start rate and chat
depth per bot, workflow and tag, AIGC-vs-all comparisons, and the tag
dimensions they need — each a multi-day DataFrame job keyed by ``event_date``.
"""

__version__ = "0.1.0"
