"""Fixed values that must equal the migrated system's behaviour.

They are stated plainly here so every operator reads them from one place.
"""

# --- fixed values ---------------------------------------------------------
GIB = 1024 * 1024 * 1024
MIB = 1024 * 1024
TIB = 1024 * GIB

DAILY_QUOTA_BYTES = 60 * TIB          # daily retrieval quota (DQL)
DEFAULT_PARTITION_SIZE = 10000        # archives per request partition, max
PARTITIONS_PER_DAY = 16               # request partitions per day, min
CHUNK_SIZE = 4 * GIB                  # copy / hash / release range unit
INVENTORY_PART_SIZE = 4 * GIB         # inventory download part unit
OVERRIDE_PART_SIZE = 2 * GIB          # override-list copy part unit
TREE_HASH_LEAF = 1 * MIB              # tree-hash leaf
MIN_THROTTLING_DELAY = 960            # seconds to wait when throttled
MAX_HASH_RETRIES = 3                  # hash mismatches before an archive fails
DELETE_BATCH = 1000                   # keys per delete request
SECONDS_PER_DAY = 86400
METRIC_WINDOW = "5 minutes"           # dashboard period (300 s)
METRIC_UNIT = "None"                  # unit recorded on every metric point
UNDEFINED_PREFIX = "00undefined/"     # name used when a description is empty

# Progress counters: status field -> counter name.
STAGE_FIELDS = [("cdt", "requested"), ("sgt", "staged"), ("vdt", "validated"), ("cpt", "copied")]

# Metric names published once a minute.
METRIC_COUNT_NAMES = [
    ("requested", "ArchiveCountRequested"),
    ("staged", "ArchiveCountStaged"),
    ("validated", "ArchiveCountValidated"),
    ("copied", "ArchiveCountCompleted"),
]
METRIC_BYTES_NAMES = [
    ("requested", "BytesRequested"),
    ("staged", "BytesStaged"),
    ("validated", "BytesValidated"),
    ("copied", "BytesCompleted"),
]

# Log lines that count as errors: these three spellings only, minus two known noises.
ERROR_SPELLINGS = ["error", "Error", "ERROR"]
ERROR_NOISE = ["ThrottlingException", "Idle connections will be closed"]

# Whitespace removed by a JavaScript-style trim (beyond what Spark's trim removes),
# as a regex class and as the literal set of characters.
JS_WHITESPACE = "\\s\\u00A0\\uFEFF\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"
JS_WHITESPACE_CHARS = ("\t\n\v\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
                       "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff")

# Shapes of an archive description, in the order they are tried.
M_FORM = "<m>.*</m>"
METADATA_FORM = "<ArchiveMetadata>.*</ArchiveMetadata>"
JSON_FORM = '\\{\\s*\\\\*".*\\}\\s*'
