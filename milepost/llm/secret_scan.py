"""Secret scan: candidates by form, false positives removed by a random forest.

A candidate is a run of ``MIN_CHARS`` or more letters, digits and ``+ / _ -`` inside a word.
The forest sees its length, how often its characters change class, how many of them known
words cover, whether it lies in a path or address, and the words beside it. It is trained on
labelled findings; ``seed_labels`` gives such labels where the form alone is decisive (issued
key formats, values assigned to a credential's name; digit strings, identifiers, plain
words), and the forest judges all others by the same features. Everything is columns and
Spark's own forest; no Python runs on executors.

Training takes ``TRAIN_FINDINGS`` labelled findings at most, in the order of a hash; all
findings are judged. With labels of one class only, or none, a finding is a secret where its
own seed label says so. Null and empty texts have no findings; equal texts are scanned once;
repeated rows give repeated findings; an empty table gives empty results. Only key and text
are read by ``scan``; ``redact`` returns the columns of its input, clashing names included.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.llm.common import let
from milepost.session import staged

MIN_CHARS = 16
TRAIN_FINDINGS = 5_000
TREES, DEPTH = 20, 6
# Values to redact are broadcast up to this number of texts, joined by shuffle beyond.
BROADCAST_TEXTS = 200_000
MARK = "[REDACTED]"
RUN = rf"[A-Za-z0-9+/_\-]{{{MIN_CHARS},}}"

NAMES = r"(?i)(token|secret|passw|pwd|passphrase|api_?key|access_?key|private_?key|auth|bearer|credential)"
HARMLESS = r"(?i)(sha1|sha256|md5|commit|checksum|digest|uuid|guid|isbn|order|invoice|card|phone|example|sample)"
ISSUED = (
    r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^sk_(live|test)_[A-Za-z0-9]{16,}$|"
    r"^xox[abprs]-[A-Za-z0-9\-]{10,}$|^glpat-[A-Za-z0-9_\-]{20,}$|^eyJ[A-Za-z0-9_\-]{16,}$|^AIza[A-Za-z0-9_\-]{35}$"
)
UUID = r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"
CHANGES = r"(?=[a-z][0-9A-Z]|[A-Z][a-z0-9]|[0-9][A-Za-z])"
# Frequent words and word parts of English, German, French and Spanish.
KNOWN = (
    "tion|ment|ing|and|the|ent|ion|ver|ung|heit|keit|lich|sch|ein|der|die|und|ich|che|ver|que|eau|eux|aux|our|ous|"
    "ent|ant|est|les|des|con|cion|para|por|los|las|ado|ida|able|ness|ance|ence|ally|over|under|with|this|that|from|"
    "have|er|en|on|an|re|th|st|in|es|at|ou|le|de|la|te|or|ar|al|he|ed|it|is|ti"
)
FEATURES = [
    "length", "changes", "digits", "upper", "distinct", "hex", "known", "vowels", "in_path", "quoted", "assigned",
    "named", "harmless",
]


def findings(texts: DataFrame) -> DataFrame:
    """Candidates of texts (digest, text): digest, place of the word, value, word and its neighbours."""
    words = F.split(F.col("text"), r"[\x20\x09-\x0D]+")

    def around(w: Column) -> Column:
        marked = F.transform(
            w,
            lambda x, i: F.when(
                (F.length(x) >= MIN_CHARS) & x.rlike(RUN),
                F.struct(
                    i.alias("place"),
                    x.alias("word"),
                    F.regexp_extract_all(x, F.lit(RUN), F.lit(0)).alias("values"),
                    F.concat_ws(" ", F.get(w, i - 2), F.get(w, i - 1)).alias("before"),
                    F.coalesce(F.get(w, i + 1), F.lit("")).alias("after"),
                ),
            ),
        )
        return F.filter(marked, lambda x: x.isNotNull())

    found = texts.select("digest", F.explode(let(words, around)).alias("x"))
    return found.select("digest", "x.place", "x.word", "x.before", "x.after", F.explode("x.values").alias("value"))


def described(found: DataFrame) -> DataFrame:
    """The findings with the features of the forest."""
    value, word = F.col("value"), F.col("word")
    n = F.length(value).cast("double")
    head = F.call_function("substring_index", word, value, F.lit(1))  # what stands before the value in its word
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / n
    yes = lambda condition: condition.cast("double")
    lead = F.concat_ws(" ", "before", head)
    return found.withColumns(
        {
            "length": n,
            "changes": share(CHANGES),
            "digits": share("[0-9]"),
            "upper": share("[A-Z]"),
            "distinct": F.size(F.array_distinct(F.split(value, ""))) / n,
            "hex": yes(value.rlike("^[0-9a-fA-F]+$")),
            "known": F.lit(1.0) - F.length(F.regexp_replace(F.lower(value), KNOWN, "")) / n,
            "vowels": share("[aeiouAEIOU]"),
            "in_path": yes(word.rlike(r"://|@|^/|/.*/|\.[a-z]{2,4}$")),
            "quoted": yes(head.rlike("[\"'`]$")),
            "assigned": yes(lead.rlike("[=:] ?[\"'`]?$")),
            "named": yes(lead.rlike(NAMES + r"[\"'\]]? ?[=:]? ?[\"'`]?$") | lead.rlike(NAMES)),
            "harmless": yes(lead.rlike(HARMLESS) | F.col("after").rlike(HARMLESS)),
        }
    )


def seed_labels(found: DataFrame) -> DataFrame:
    """The findings with ``label``: 1 or 0 where the form is decisive, else null."""
    value = F.col("value")
    digits = value.rlike(r"^[0-9\-]+$")
    secret = value.rlike(ISSUED) | (
        (F.col("named") == 1) & (F.col("assigned") == 1) & (F.col("digits") > 0) & (F.col("harmless") == 0) & ~digits
    )
    plain = digits | value.rlike(UUID) | value.rlike(r"^[A-Za-z_\-]+$") | (F.col("in_path") == 1)
    return found.withColumn("label", F.when(secret, 1.0).when(plain, 0.0))


def train(labelled: DataFrame):
    """Forest over findings with features and ``label``; None unless both labels occur."""
    known = labelled.filter(F.col("label").isNotNull()).select(*FEATURES, "label")
    # Both classes are taken alike, so that rare secrets are not outnumbered.
    sample = None
    for label in (0.0, 1.0):
        part = known.filter(F.col("label") == label).orderBy(F.xxhash64(*FEATURES)).limit(TRAIN_FINDINGS // 2)
        sample = part if sample is None else sample.unionAll(part)
    sample = staged(sample.coalesce(1))
    if sample.select("label").distinct().count() < 2:
        return None
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=17).fit(ready.select("features", "label"))


def judge(found: DataFrame, model) -> DataFrame:
    """The findings with ``probability`` and ``is_secret``."""
    if model is None:
        scored = found.withColumn("probability", F.coalesce(F.col("label"), F.lit(0.0)))
    else:
        ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
        scored = model.transform(ready).withColumn("probability", vector_to_array("probability")[1])
        scored = scored.drop("features", "rawPrediction", "prediction")
    return scored.withColumn("is_secret", F.col("probability") >= 0.5)


def _judged(docs: DataFrame, text: str) -> DataFrame:
    """Judged findings of all distinct texts that have a candidate."""
    texts = docs.select(docs[text].alias("text")).filter(F.col("text").rlike(RUN))
    texts = texts.groupBy(F.unhex(F.md5("text")).alias("digest")).agg(F.first("text").alias("text"))
    found = staged(seed_labels(described(findings(texts))))
    return judge(found, train(found))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row and finding: key, place of its word, value, features, probability, is_secret."""
    judged = staged(_judged(docs, text))
    rows = docs.select(docs[key], docs[text].alias("_text")).filter(F.col("_text").rlike(RUN))
    rows = rows.select(key, F.unhex(F.md5("_text")).alias("digest"))
    return rows.join(judged, "digest").drop("digest")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with every value judged a secret replaced in its text."""
    secrets = _judged(docs, text).filter("is_secret").groupBy("digest").agg(F.collect_set("value").alias("values"))
    secrets = staged(secrets)
    few = secrets.count() <= BROADCAST_TEXTS
    names = docs.columns
    inner = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), F.unhex(F.md5(docs[text])).alias("digest"))
    joined = inner.join(F.broadcast(secrets) if few else secrets, "digest", "left")
    # The longest first, so that a value inside another leaves no rest of it.
    longest = F.array_sort("values", lambda a, b: F.length(b) - F.length(a))
    clean = F.aggregate(longest, F.col(f"row.`{text}`"), lambda rest, x: F.replace(rest, x, F.lit(MARK)))
    changed = F.when(F.col("values").isNull(), F.col(f"row.`{text}`")).otherwise(clean)
    return joined.select(*[changed.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in names])
