"""Secret scan with a random forest that removes false positives, in DataFrame functions and Spark ML only.

Candidates are long runs of key-like characters. Each is described by its length, by how usual its character transitions are in
the corpus, by how much of it is made of dictionary fragments, and by what labelled findings say about its path and
neighbouring words. Vocabulary, transitions and fragments are counted over all documents.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

WORD_BREAK = r"[ \t\n\x0B\f\r]+"
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}"
EDGES = ".,;:!?\"'()[]{}<>#*$%&|="
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"
FRAGMENT = 4
DICTIONARY_COUNT = 20
"""A word that occurs so often in the corpus is in the dictionary."""
BUCKETS = 1024
"""Hash buckets for neighbouring words and paths: what is learned of them is so many rows."""
TRAIN_ROWS = 200_000
"""Most labelled findings that the forest is fitted on; of more, a sample by hash is taken."""
TREES, DEPTH = 30, 6
ROLES = ("path", "before", "before2", "after")
FEATURES = ["length", "transition", "coverage", *(f"{r}_odds" for r in ROLES)]
#: Names that credentials are assigned to.
NAMES = "token|secret|passwd|password|api_key|apikey|access_key|private_key|auth"


def words_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), WORD_BREAK)


def findings(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """Every candidate with ``_id, path, position`` (of its word), ``part`` (in its word), ``value`` and its neighbouring words.

    Null texts have none; a null id or path stays null, and rows with the same id are scanned one by one.
    """
    split = docs.select(F.col(f"`{key}`").alias("_id"), F.col(f"`{path}`").cast("string").alias("path"), words_of(F.col(f"`{text}`")).alias("words"))
    each = split.select("_id", "path", "words", F.posexplode("words").alias("position", "word"))
    found = each.where((F.length("word") >= 16) & F.col("word").rlike(CANDIDATE))
    near = [F.lower(F.get("words", F.col("position") + step)).alias(name) for name, step in (("before", -1), ("before2", -2), ("after", 1))]
    runs = found.select("_id", "path", "position", "word", *near, F.posexplode(F.regexp_extract_all("word", F.lit(CANDIDATE), F.lit(0))).alias("part", "value"))
    return runs.select("_id", F.lower("path").alias("path"), F.col("position").cast("long"), F.col("part").cast("long"), "word", "value", "before", "before2", "after")


def vocabulary(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, n``: all words in lower case, without marks at their edges, and how often they occur."""
    words = docs.select(F.explode(words_of(F.col(f"`{text}`"))).alias("word"))
    return words.groupBy(F.btrim(F.lower("word"), F.lit(EDGES)).alias("word")).agg(F.count("*").alias("n")).where("word <> ''")


def pairs_of(word: Column) -> Column:
    """The character pairs of a word; what is outside ``ALPHABET`` counts as one character."""
    plain = F.regexp_replace(F.lower(word), f"[^{ALPHABET}]", "~")
    return F.when(F.length(word) >= 2, F.transform(F.sequence(F.lit(1), F.length(word) - 1), lambda i: F.substring(plain, i, F.lit(2))))


def fragments_of(word: Column) -> Column:
    """The runs of ``FRAGMENT`` letters or digits of a word."""
    plain = F.lower(word)
    made = F.transform(F.sequence(F.lit(1), F.length(word) - FRAGMENT + 1), lambda i: F.substring(plain, i, F.lit(FRAGMENT)))
    return F.when(F.length(word) >= FRAGMENT, F.filter(made, lambda x: x.rlike(f"^[{ALPHABET}]+$")))


def transitions(words: DataFrame) -> DataFrame:
    """``pair, logp``: log probability of the second character after the first; at most 37 x 37 rows."""
    counts = words.select(F.explode(pairs_of(F.col("word"))).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n"))
    firsts = counts.groupBy(F.substring("pair", 1, 1).alias("first")).agg(F.sum("n").alias("total"))
    joined = counts.withColumn("first", F.substring("pair", 1, 1)).join(F.broadcast(firsts), "first")
    return joined.select("pair", F.log((F.col("n") + 1) / (F.col("total") + len(ALPHABET) + 1)).alias("logp"))


def described(values: DataFrame, words: DataFrame) -> DataFrame:
    """``value, length, transition, coverage`` of distinct candidate values."""
    steps = F.broadcast(transitions(words))
    rare = F.log(F.lit(1e-6))
    chars = values.select("value", F.explode(pairs_of(F.col("value"))).alias("pair")).join(steps, "pair", "left")
    usual = chars.groupBy("value").agg(F.avg(F.coalesce("logp", rare)).alias("transition"))
    listed = words.where(F.col("n") >= DICTIONARY_COUNT).select(F.explode(fragments_of(F.col("word"))).alias("piece")).distinct()
    pieces = values.select("value", F.explode(fragments_of(F.col("value"))).alias("piece"))
    covered = pieces.join(listed.withColumn("hit", F.lit(1)), "piece", "left").groupBy("value").agg((F.count("hit") / F.count("*")).alias("coverage"))
    both = values.join(usual, "value", "left").join(covered, "value", "left")
    return both.select("value", F.length("value").cast("double").alias("length"), F.coalesce("transition", rare).alias("transition"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"))


def bucket(name: str) -> Column:
    """Hash bucket of a neighbouring word or path; letters and digits count only."""
    plain = F.regexp_replace(F.coalesce(F.col(name), F.lit("")), "[^\\p{L}\\p{N}=:]+", "")
    return F.pmod(F.xxhash64(plain, F.lit(name)), F.lit(BUCKETS)).cast("int")


def odds(labelled: DataFrame) -> DataFrame:
    """``b`` and a column a role: smoothed log odds of a secret for each bucket; at most ``BUCKETS`` rows."""
    long = labelled.select("label", F.explode(F.array(*[F.struct(F.lit(r).alias("role"), bucket(r).alias("b")) for r in ROLES])).alias("x"))
    totals = long.groupBy(F.col("x.role").alias("role"), F.col("x.b").alias("b")).agg(F.sum("label").alias("hit"), F.count("*").alias("n"))
    value = F.log((F.col("hit") + 1) / (F.col("n") - F.col("hit") + 1))
    return totals.groupBy("b").agg(*[F.max(F.when(F.col("role") == r, value)).alias(f"{r}_odds") for r in ROLES])


def with_odds(found: DataFrame, table: DataFrame) -> DataFrame:
    for r in ROLES:
        side = F.broadcast(table.select(F.col("b").alias(f"_{r}"), f"{r}_odds"))
        found = found.withColumn(f"_{r}", bucket(r)).join(side, f"_{r}", "left").drop(f"_{r}")
    return found.fillna(0.0, [f"{r}_odds" for r in ROLES])


def rule_labels(found: DataFrame) -> DataFrame:
    """``found`` with ``label`` where a plain rule is sure; other candidates are left out.

    1: a quoted value of 32 or more characters with letters and digits that a credential name is assigned. 0: a value of letters only
    or of digits only, and parts of addresses.
    """
    value, word = F.col("value"), F.col("word")
    named = F.concat_ws(" ", "before2", "before").rlike(rf"(?:^|[^a-z])(?:{NAMES})\s*[=:]+$") | F.lower(word).rlike(rf"^\W*(?:{NAMES})[=:]+[\"']")
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    secret = named & mixed & (F.length(value) >= 32) & word.rlike("[\"']")
    plain = value.rlike("^[A-Za-z_-]+$") | value.rlike("^[0-9+/_-]+$") | word.rlike("://|@|^www\\.")
    return found.withColumn("label", F.when(secret, 1).when(plain & ~named, 0)).where("label IS NOT NULL")


def scan(docs: DataFrame, labelled: DataFrame | None = None, key: str = "doc_id", text: str = "text", path: str = "source", seed: int = 7, limit: float = 0.5) -> DataFrame:
    """``doc_id, position, part, value, path`` and features of every candidate, with ``score`` and ``kept`` (score >= limit).

    ``labelled``: findings with ``label`` 0 or 1, in the columns of ``findings``; without it those that ``rule_labels`` is sure of, among
    documents whose CRC-32 of the id as text doesn't leave 1 when divided by 3. If the labels are all alike or there are
    none, nothing is learned: the score is null and every candidate is kept. An empty table gives an empty result.
    """
    found = stored(findings(docs, key, text, path), "findings")
    words = stored(vocabulary(docs, text), "words")
    facts = stored(described(found.select("value").distinct(), words), "facts")
    if labelled is None:
        held = F.coalesce(F.crc32(F.col("_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
        labelled = rule_labels(found.where(~held))
    labelled = stored(labelled, "labelled")
    count = labelled.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("hit")).first()
    names = [F.col("_id").alias(key), "position", "part", "value", "path"]
    full = found.join(facts, "value")
    if count.hit in (0, count.n):
        return full.select(*names, "length", "transition", "coverage", F.lit(None).cast("double").alias("score"), F.lit(True).alias("kept"))
    table = stored(odds(labelled), "odds")
    some = labelled
    if count.n > TRAIN_ROWS:
        share = int(2**32 * TRAIN_ROWS / count.n)
        some = labelled.where(F.pmod(F.xxhash64("_id", "position", "part", F.lit(seed)), F.lit(2**32)) < share)
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
    training = assemble.transform(with_odds(some.join(facts, "value"), table)).select("features", F.col("label").cast("double").alias("label"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="onethird", cacheNodeIds=False)
    model = forest.fit(stored(training, "training"))
    scored = model.transform(assemble.transform(with_odds(full, table)))
    score = vector_to_array("probability")[1]
    return scored.select(*names, *FEATURES, score.alias("score"), (score >= limit).alias("kept"))
