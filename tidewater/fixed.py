"""These must equal the reference's for the results to match.

They are stated here, together, and imported where they are used.
"""

# --- Fixed values (do not change) ---------------------------------------------

# Window bounds and poll times are wall-clock text in this format
# (yyyy-MM-dd HH:mm:ss), whole seconds.
TIME_FORMAT = "%Y-%m-%d %H:%M:%S"

# Poll interval in milliseconds when the setting is empty or not a number.
DEFAULT_INTERVAL_MS = 60000

# Text of a missing or null value when values are bound or stored as text.
NULL_TEXT = "null"

# Error for a sink statement kind other than these three.
SINK_MODES = ("insert", "update", "upsert")
SINK_MODE_ERROR = "only insert, update or upsert supported"

# The people record: position 0, 1, 2 of a space-separated line.
PEOPLE_FIELDS = (("id", "long"), ("name", "string"), ("age", "int"))
PEOPLE_SEPARATOR = " "

# The range query over people: ages 13 to 19, both ends included.
AGE_LO, AGE_HI = 13, 19

# The template: result = (id == "2"), printed between these tags, one per line.
TEMPLATE_OPEN, TEMPLATE_CLOSE = "<test>", "</test>"
TEMPLATE_KEY = "2"

# The template as text: the same assignment and quiet reference, below an XML declaration.
TEMPLATE_TEXT = """<?xml version="1.0" encoding="UTF-8"?>
<test>
#set($result=$map.get("id") == "2")
$!result
</test>"""
