"""Fixed values that must equal the original jobs' values for identical results.

Fixed values (kept verbatim, in natural order):

* bot types: ``AIGC``, ``AllBots``; the all-bots workflow label: ``ALL``
* metric type names: ``click_rate``, ``chat_start_rate``, ``chat_depth_user``
* event names in the per-version event count table: ``view_bot``, ``show_prompt_card``
* chat method excluded by chat depth by tag: ``regenerate``
* tag path markers (case-sensitive substring): ``V5``, ``Luna``
* V5 tag-name prefix pattern removed by the enrichment job: ``^V5\\s+``
* separator of the concatenated tag list: ``,``
* decimals: 4 for rates and the compare-report chat depth, 2 for per-user chat rounds
"""

AIGC = "AIGC"
ALL_BOTS = "AllBots"
ALL_WORKFLOWS = "ALL"

CLICK_RATE = "click_rate"
CHAT_START_RATE = "chat_start_rate"
CHAT_DEPTH_USER = "chat_depth_user"
METRIC_TYPES = (CLICK_RATE, CHAT_START_RATE, CHAT_DEPTH_USER)

EVENT_VIEW_BOT = "view_bot"
EVENT_SHOW_PROMPT_CARD = "show_prompt_card"

METHOD_REGENERATE = "regenerate"

PATH_V5 = "V5"
PATH_LUNA = "Luna"
V5_PREFIX_PATTERN = r"^V5\s+"

TAG_SEPARATOR = ","

RATE_DECIMALS = 4
ROUNDS_DECIMALS = 2
