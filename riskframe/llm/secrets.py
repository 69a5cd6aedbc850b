"""Secret scan with a random forest that removes false positives, in DataFrame and ML pipeline operations only.

Candidates are runs of at least MIN_LENGTH characters of the base64 and hexadecimal alphabets that hold a digit ('=' only as padding at
the end), and what is assigned to a name of credentials or stands quoted after one, whatever its characters and length. A quoted
value goes on over white space (read as one space) to its closing quote, as far as QUOTED_WORDS words. Features of a
candidate: its length; its character transitions (changes between letters and digits and between cases, and the mean
log-probability of its letter pairs in the corpus); dictionary coverage (share of its letters that lie in words of the
corpus); its path (a hash of the source); and its neighbouring words (assignment sign, quotes, words that name
credentials before it, word lengths beside it).

The dictionary and the letter pairs are counted over all words (of 3 to 32 letters) of all documents, the dictionary
holds those seen DICTIONARY_COUNT times or more: words are summed with a map-side part, pairs
are counted from the word counts. Features that depend on the value alone are computed once per distinct value.

Labelled findings are a table (the operator takes any); where none is given, ``labelled`` supplies weak labels: a candidate
in one of the public credential formats that is assigned or quoted is a secret, any other is not, but for other
assigned or quoted values after a name of credentials: they may be either, have no label and are not trained on. The forest is trained on at most
TRAIN_PER_LABEL findings per label, those with the smallest hash of value and place.

Defined results: null and empty texts have no candidates. Repeated rows give repeated findings. If the
labels are all alike there is nothing to learn: the score is that label. Empty table: empty result. Other
columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import text_or_empty
from riskframe.session import reliable_checkpoint

MIN_LENGTH = 12
#: Words seen this often in the corpus make its dictionary.
DICTIONARY_COUNT = 5
TRAIN_PER_LABEL = 10_000
TREES, DEPTH, SEED = 30, 6, 7

# The run of characters that is a candidate, words that name credentials, public credential formats.
RUN = rf"[A-Za-z0-9+/_\-]{{{MIN_LENGTH},}}(?:={{1,2}}(?![A-Za-z0-9+/_=\-]))?"
NAMES = "secret|token|passw|pwd|api|key|auth|credential|bearer|private|access"
FORMATS = (r"^(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{64})$|^(?:.*/)?(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk_(?:live|test)_[A-Za-z0-9]{16,}"
           r"|xox[abprs]-[A-Za-z0-9\-]{10,}|AIza[0-9A-Za-z_\-]{35}|eyJ[A-Za-z0-9_\-]{16,})$")
# A name of credentials to its end, an assignment sign; names and values of a query string.
NAME = rf"(?i:{NAMES})[A-Za-z0-9_.\[\]()\-]{{0,64}}[\"'`]?"
SIGN = r"(?:[:=]=?>?)"
QUERY = rf"[?&][A-Za-z0-9_.\-]{{0,64}}(?i:{NAMES})[A-Za-z0-9_.\-]{{0,64}}=([^&#\"'`]+)"
QUOTES = "\"'`"
SCHEME = rf"^[{QUOTES}]?(?i:bearer|basic|token)$"
#: Words that a quoted value may have.
QUOTED_WORDS = 64

FEATURES = ["length", "digit_changes", "case_changes", "pair_score", "coverage", "path", "assigned", "quoted", "named",
            "before_length", "after_length"]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """One row per candidate: doc_id, place (number of its word), value, path and neighbouring words."""
    words = F.split(text_or_empty(text_col), r"[\x20\x09-\x0D]+")
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path_text"), words.alias("w"))
    w = F.col("w")
    near = lambda i: F.coalesce(F.get(w, i), F.lit(""))
    hit = lambda x: (F.length(x) >= MIN_LENGTH) & x.rlike(r"[0-9]") & x.rlike(RUN)
    given = lambda i: _assigned_inside(near(i)) | _assigned_before(near(i), near(i - 1), near(i - 2))
    found = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: hit(F.get(w, i)) | given(i))
    rows = src.select("doc_id", "path_text", F.explode(F.transform(found, lambda i: F.struct(
        i.alias("place"), F.get(w, i).alias("word"), near(i - 1).alias("b1"), near(i - 2).alias("b2"), near(i - 3).alias("b3"),
        near(i + 1).alias("after"), F.when(given(i), F.array_join(F.slice(w, i + 1, QUOTED_WORDS), " ")).alias("long")))).alias("c")).select(
        "doc_id", "path_text", "c.*")
    runs = F.filter(F.regexp_extract_all("word", F.lit(f"({RUN})")), lambda v: v.rlike("[0-9]"))
    rows = rows.withColumn("value", F.explode(F.array_distinct(F.concat(runs, _assigned_values()))))
    return rows.withColumn("word", F.when(F.contains("word", "value"), F.col("word")).otherwise(F.col("long"))).drop("long")


def _assigned_inside(word: Column) -> Column:
    """Whether a word holds a name of credentials and what is assigned to it."""
    return word.rlike("[=:].") & (word.rlike(rf"{NAME}{SIGN}[^=:>]") | word.rlike(QUERY))


def _assigned_before(word: Column, b1: Column, b2: Column) -> Column:
    """Whether a word starts a value that is assigned to a name of credentials in the words before it, or quoted after one."""
    sign = b1.rlike("[=:]>?$") & (b1.rlike(rf"{NAME}{SIGN}$") | b1.rlike(rf"^{SIGN}$") & b2.rlike(rf"{NAME}$"))
    marked = word.rlike(rf"^(?:{SIGN}|[{QUOTES}])") & b1.rlike(rf"{NAME}$")
    scheme = b2.rlike(rf"{NAME}{SIGN}$") & b1.rlike(SCHEME)
    return word.rlike(rf"[^=:>{QUOTES},;]") & (sign | marked | scheme)


def _assigned_values() -> Column:
    """Values that are assigned to a name of credentials or quoted after one, of the columns word, long, b1 and b2."""
    word, text = F.col("word"), F.col("long")
    # what is closed in quotes may go on over the next words, but has to start in this one
    quoted = lambda before, q: F.regexp_extract_all(text, F.lit(rf"{before}{q}([^{q}]+){q}"))
    begun = lambda before, q: F.regexp_extract_all(word, F.lit(rf"{before}{q}([^{q}]+)$"))
    plain = lambda v: F.regexp_replace(F.when(word.rlike(r"[(\[{<]"), F.regexp_replace(v, r"[)\]}>]+[,;.]*$", "")).otherwise(v), "[,;]+$", "")
    starts = lambda v: F.contains(word, F.substring_index(v, " ", 1))

    def values(before: str, rest: Column) -> Column:
        closed = F.filter(F.concat(*[quoted(before, q) for q in QUOTES]), starts)
        openly = F.concat(*[begun(before, q) for q in QUOTES])
        return F.concat(closed, F.when(F.size(closed) == 0, openly).otherwise(F.array().cast("array<string>")), rest)

    query = F.regexp_extract_all(word, F.lit(QUERY))
    free = F.transform(F.regexp_extract_all(word, F.lit(rf"{NAME}{SIGN}([^=:>{QUOTES}][^{QUOTES}]*)")), plain)
    inside = values(rf"{NAME}{SIGN}", F.when(F.size(query) > 0, query).otherwise(free))
    after = values(rf"^{SIGN}?", F.transform(F.regexp_extract_all(word, F.lit(rf"^{SIGN}?([^=:{QUOTES}][^{QUOTES}]*)")), plain))
    none = F.array().cast("array<string>")
    both = F.concat(F.when(_assigned_inside(word), inside).otherwise(none),
                    F.when(_assigned_before(word, F.col("b1"), F.col("b2")) & ~_assigned_inside(word), after).otherwise(none))
    return F.filter(both, lambda v: F.length(v) > 0)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Counts of all lower-cased words of 3 to 32 letters a-z in all documents."""
    words = F.split(F.lower(text_or_empty(text_col)), r"[^a-z]+")
    return docs.select(F.explode(words).alias("word")).filter("length(word) between 3 and 32").groupBy("word").agg(
        F.count(F.lit(1)).alias("n"))


def _pairs(rows: DataFrame) -> DataFrame:
    """``rows`` by pair of neighbouring characters of the array column ``chars``."""
    rest = F.slice("chars", F.lit(2), F.size("chars"))
    pairs = F.filter(F.zip_with("chars", rest, lambda a, b: F.concat(a, b)), lambda p: p.isNotNull())
    others = [c for c in rows.columns if c != "chars"]
    return rows.select(*others, pairs.alias("pairs")).select(*others, F.explode("pairs").alias("pair"))


def letter_pairs(counts: DataFrame) -> DataFrame:
    """(pair, logp): log-probability of the second letter after the first; at most 36 x 36 rows."""
    pairs = _pairs(counts.select("n", F.split("word", "").alias("chars")))
    pairs = pairs.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("first", F.substring("pair", 1, 1))
    totals = pairs.groupBy("first").agg(F.sum("n").alias("of"))
    return pairs.join(F.broadcast(totals), "first").select("pair", F.log((F.col("n") + 0.5) / (F.col("of") + 20.0)).alias("logp"))


def features(found: DataFrame, counts: DataFrame) -> DataFrame:
    """``found`` with the feature columns."""
    dictionary = counts.filter(F.col("n") >= DICTIONARY_COUNT).select(F.col("word").alias("run"))
    found = found.withColumn("vid", F.md5(F.col("value").cast("binary")))
    values = found.groupBy("vid").agg(F.first("value").alias("value"))
    runs = values.select("vid", F.explode_outer(F.regexp_extract_all(F.lower("value"), F.lit("([a-z]{3,})"))).alias("run"))
    known = dictionary.withColumn("known", F.lit(1))
    covered = runs.join(known, "run", "left").groupBy("vid").agg(
        F.coalesce(F.sum(F.when(F.col("known") == 1, F.length("run"))), F.lit(0)).alias("letters"))
    pairs = _pairs(values.select("vid", F.split(F.lower("value"), "").alias("chars")))
    likely = pairs.join(F.broadcast(letter_pairs(counts)), "pair", "left").groupBy("vid").agg(
        F.avg(F.coalesce("logp", F.lit(-7.0))).alias("pair_score"))
    rows = found.join(covered, "vid").join(likely, "vid", "left").withColumn("pair_score", F.coalesce("pair_score", F.lit(-7.0)))
    before = F.lower(F.concat_ws(" ", "b3", "b2", "b1", F.expr("substring_index(word, value, 1)")))
    count = lambda pattern: F.regexp_count("value", F.lit(pattern)).cast("double")
    length = F.length("value").cast("double")
    flag = lambda c: c.cast("double")
    inside = F.expr("substring_index(word, value, 1)")
    return rows.select(
        "doc_id", "place", "value", length.alias("length"),
        (count("(?=[A-Za-z][0-9]|[0-9][A-Za-z])") / length).alias("digit_changes"),
        (count("(?=[a-z][A-Z]|[A-Z][a-z])") / length).alias("case_changes"), "pair_score",
        (F.col("letters") / length).alias("coverage"), F.pmod(F.xxhash64("path_text"), F.lit(32)).cast("double").alias("path"),
        flag(inside.rlike("[=:]") | F.col("b1").rlike("[=:]$") | F.col("b2").rlike("[=:]$") & F.col("b1").rlike(SCHEME)).alias("assigned"), flag(inside.rlike("[\"'`]$")).alias("quoted"),
        flag(before.rlike(NAMES)).alias("named"),
        F.length("b1").cast("double").alias("before_length"), F.length("after").cast("double").alias("after_length"))


def labelled(found: DataFrame) -> DataFrame:
    """Weak labels for findings with features: 1 for an assigned or quoted value in a public credential format, null for
    another such value after a name of credentials, else 0."""
    given = (F.col("assigned") == 1) | (F.col("quoted") == 1)
    secret = F.col("value").rlike(FORMATS) & given
    return found.withColumn("label", F.when(secret | ~given | (F.col("named") == 0), secret.cast("double")))


def _first(rows: DataFrame, label: float) -> DataFrame:
    return rows.filter(F.col("label") == label).orderBy(F.xxhash64("value", "doc_id", "place"), "value").limit(TRAIN_PER_LABEL)


def train(findings: DataFrame):
    """A forest from labelled findings with features, or the label (0.0 or 1.0) if all are alike; None without any."""
    sample = reliable_checkpoint(_first(findings, 0.0).union(_first(findings, 1.0)).select(*FEATURES, "label"))
    labels = sorted(r.label for r in sample.select("label").distinct().collect())
    if len(labels) < 2:
        return labels[0] if labels else None
    forest = RandomForestClassifier(featuresCol="vector", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(sample))


def classify(found: DataFrame, model, threshold: float = 0.5) -> DataFrame:
    """Findings with score (probability of a secret) and is_secret."""
    if model is None or isinstance(model, float):
        scored = found.withColumn("score", F.lit(model).cast("double"))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(found)
        scored = model.transform(vectors).withColumn("score", vector_to_array("probability")[1]).drop("vector", "rawPrediction", "probability", "prediction")
    return scored.withColumn("is_secret", F.col("score") >= threshold)


def scan(docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """All candidates of ``docs`` with features, score and is_secret. ``findings``: labelled findings with the
    feature columns and ``label``; default: weak labels on the candidates themselves."""
    counts = reliable_checkpoint(word_counts(docs, text_col))
    found = reliable_checkpoint(candidates(docs, id_col, text_col, path_col))
    known = reliable_checkpoint(features(found, counts))
    return classify(known, train(labelled(known) if findings is None else findings))
