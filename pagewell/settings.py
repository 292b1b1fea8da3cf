"""Defaults of the engine and the size bounds its plans rely on."""

# --- fixed values: results depend on these numbers and words ----------------
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 200
LOOKAHEAD = 200
MIN_CHUNK_CHARS = 500
EMBEDDING_DIM = 768
BATCH_SIZE = 16
TOP_K = 5
SLICE_SIZE = 128
WORKERS = 4
NLIST = 4096
NPROBE = 16
ID_STRIDE = 1_000_000
DOCUMENT_TASK = "RETRIEVAL_DOCUMENT"
QUERY_TASK = "RETRIEVAL_QUERY"
PAPER_SOURCES = ("arxiv", "semanticscholar", "springernature")
PROMPT_TEMPLATE = "\nUse the following context to answer the question.\n\nContext:\n%s\n\nQuestion:\n%s\n"
CONTEXT_SEPARATOR = "\n\n"
PDF_MAGIC = "%PDF"

# --- precision ---------------------------------------------------------------
# Vectors are float32, about seven significant digits. Scores are summed in
# double, reported at six decimals, and equal scores are ordered by id, so a
# result does not depend on how the rows were partitioned. Ranks go by the
# unrounded score.
SCORE_DECIMALS = 6

# --- size bounds -------------------------------------------------------------
# Largest block of query vectors held by every task at once (rows, and bytes as
# float64). Larger sets are taken past the vectors block after block.
QUERY_BLOCK_ROWS = 4096
QUERY_BLOCK_BYTES = 64 * 1024 * 1024
# Vectors a task gathers before it takes the blocks past them (bytes), and (query,
# candidate) entries it keeps in one scan of the index.
GATHERED_BYTES = 32 * 1024 * 1024
SCAN_ENTRIES = 8_000_000
# Probed lists that are named one by one in the filter of a scan.
LISTED_LISTS = 1_000
# Centroids of inverted lists held by every task at a time.
MAX_LISTS = 65_536
# Most batches whose names are put into a reader's folder filter.
LISTED_BATCHES = 10_000
# Most rounds of papers that are planned at a time; one id each is held by the driver.
ROUND_BOUNDS = 100_000
# Tokens whose slots a worker of the hash embedder keeps, and the longest of them.
MEMO_TOKENS = 65_536
MEMO_CHARS = 40
# Vectors a task has to read when inverted lists are trained (bytes as float64), and
# those of one file of a list (bytes as float32).
TRAINING_BYTES = 64 * 1024 * 1024
LIST_FILE_BYTES = 64 * 1024 * 1024
# Steps a pass over the papers is taken in at most; a step takes its rounds side by side.
PASS_STEPS = 8
# Ranges of ids a table is laid out by where steps read one range after the other.
KEY_RANGES = 32
# Papers of a round whose rows one task writes, where a step has many rounds, and the
# rounds up to which the rows of a step are written as they come.
BATCH_FILE_PAPERS = 1_024
UNGATHERED_BATCHES = 16
# Most paths of landed files the driver lists for one read.
LISTED_FILES = 10_000
# Rows a caller may declare as an upper bound for a broadcast side.
BROADCAST_ROWS = 100_000
# Most ids, with no other column, that are sent to the texts of a step (8 MB of numbers).
BROADCAST_IDS = 1_000_000
# Pages of one document that are numbered by one task on the flat route.
PAGE_BLOCK = 1024
# log2 of the id range numbered by one task (ids are unique integers, so a
# range of 2**20 ids holds at most 2**20 rows however skewed the table is).
ID_RANGE_BITS = 20
