"""Table schemas, column orders and the fixed settings of the workload."""

from pyspark.sql import types as T


def _strings(*names):
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Column names and orders of the corpus and of an ingest shard.
CORPUS_COLUMNS = [
    "link", "date", "title_original", "text_original",
    "title_ukrainian", "text_ukrainian", "category",
]
SHARD_COLUMNS = [
    "link", "date", "title_original", "title_ukrainian",
    "text_original", "text_ukrainian", "category",
]
META_COLUMNS = ["link", "date", "title_original", "category"]

CORPUS_SCHEMA = _strings(*CORPUS_COLUMNS)
SHARD_SCHEMA = _strings(*SHARD_COLUMNS)

VECTOR_SCHEMA = T.StructType(
    list(_strings(*META_COLUMNS))
    + [
        T.StructField("embedding", T.ArrayType(T.FloatType(), False)),
        T.StructField("shard", T.StringType()),
    ]
)
RESULT_SCHEMA = (
    "scale bigint, method string, build_time_s double, "
    "avg_query_ms double, recall_at_10 double"
)

# Thresholds.
SHORT_CHARS = 100
LONG_CHARS = 20_000
MIN_CONTENT_CHARS = 50
MIN_CHUNK_CHARS = 20
REPEAT_THRESHOLD = 10
SWEEP_THRESHOLDS = [0, 1, 2, 5, 10, 20]
EXPECTED_ROWS = 120_617
MIN_FILE_BYTES = 100_000_000
BOILERPLATE_MARKERS = ["Patreon", "patreon.com"]

# Links that a person confirmed as broken.
KNOWN_BAD_LINKS = [
    "https://www.eurointegration.com.ua/news/2022/04/14/7137846/?fbclid=IwAR0BTIy8JL5z9eqDQxTy8H9aMk_pRAFzFlPpcmi3umYK1SVqgT_8WWribJc",
    "https://www.eurointegration.com.ua/news/2023/04/25/7160484/",
    "https://www.eurointegration.com.ua/news/2023/11/25/7174284/",
    "https://www.eurointegration.com.ua/news/2024/08/24/7192735/",
    "https://www.bbc.com/news/videos/cm2kdrnp99zo",
]

# Embedding and search settings.
BATCH_SIZE = 128
SCALES = [5_000, 20_000, 50_000, None]
N_QUERIES = 200
TOP_K = 10
SEED = 42
NPROBE_FRACTION = 0.10
GRAPH_M = 32
EF_SEARCH = 64

# The texts that pandas reads as missing in a CSV field.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Every character Python's str.strip() removes; all lie below U+3100.
WHITESPACE = "".join(chr(c) for c in range(0x3100) if chr(c).isspace())

# Names of the methods in charts.
METHOD_LABELS = {
    "brute_force": "Brute-force (exact)",
    "ivf": "IVF (cluster-pruned)",
    "graph": "Graph walk",
}
