"""Fixed values that results depend on, as plain text."""

# Change operation codes and their long names.
OPERATION_NAMES = {"c": "CREATE", "r": "READ", "u": "UPDATE", "d": "DELETE"}

# Where a routing rule sends a row.
SINK_TOPIC = "kafka"
SINK_DIMENSION = "hbase"

# Page and item names in the page log.
PAGE_DETAIL = "good_detail"
PAGE_SEARCH = "search"
ITEM_SKU = "sku_id"

# The appraisal that counts as a good comment, the source of search words.
APPRAISE_GOOD = "1201"
SOURCE_SEARCH = "SEARCH"

# Text forms of times.
DAY_FORMAT = "yyyy-MM-dd"
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
