"""Secret scans: a random forest that removes false positives among candidate strings."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockpulse.session import stage

MIN_LENGTH = 16
# Of strings that are assigned to a key name.
MIN_ASSIGNED = 4
# Distinct labelled vectors that the forest is trained on, at most.
TRAINING_ROWS = 20_000
TREES, DEPTH, SEED = 24, 6, 11
THRESHOLD = 0.5
SPACES = "[\\x20\\x09-\\x0D]+"
VALUE = f"[A-Za-z0-9+/_=-]{{{MIN_LENGTH},}}"

# Names that secrets are assigned to, and common pieces of ordinary words.
KEY_NAMES = "token|secret|password|passwd|pwd|apikey|api_key|api-key|access_key|private_key|credential|auth|bearer"
# A name that ends in a key name, or goes on behind it; what may stand around a value that is assigned to it.
KEY = f"(?i)(?:{KEY_NAMES})(?:s|key|value|string)?(?![A-Za-z])[A-Za-z0-9_-]*[\"'`]?"
QUOTES = "[\\[({\"'`]*"
ASSIGNED = f"[^\\s\"'`,;&{{}}()<>\\[\\]]{{{MIN_ASSIGNED},}}"
PIECES = (
    "the and ing ion ent tion ther ment able ness less ship ight ough ance ence com org net www http html example test data user name "
    "file path page image style color index value table class node item list text word line time date year month"
).split()

# Formats of issued keys, of signed tokens, of their parts, of UUIDs and of digests.
ISSUED = "^(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_(?:live|test)_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})$"
TOKEN = "eyJ[A-Za-z0-9_-]{10,}\\.eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}"
TOKEN_PART = "^[A-Za-z0-9_-]{16,}$"
UUID = "^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"
DIGEST = "^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"
MADE_FINDINGS = 4000

FEATURES = (
    "n_chars", "digit_share", "upper_share", "lower_share", "other_share", "hex_share", "transitions", "switches_case",
    "repeats", "dictionary", "quoted", "assigned", "key_before", "path_like", "url_like", "plain_before", "plain_after",
)


def _share(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.length(value)


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, place, value, word, before, before2, after): candidate strings and the words around.

    These are all runs of ``MIN_LENGTH`` characters with a digit in a word, and what is assigned to a key name, from
    ``MIN_ASSIGNED`` characters, in the same word or by the words before.  Equal strings of one word come once.
    """
    words = F.split(F.coalesce("text", F.lit("")), SPACES)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words.alias("words"))
    none = F.array().cast("array<string>")

    def found(word: Column, i: Column) -> Column:
        before2, before, after = (F.coalesce(F.get("words", i + d), F.lit("")) for d in (-2, -1, 1))
        long = F.when(
            (F.length(word) >= MIN_LENGTH) & word.rlike("[0-9]") & word.rlike(VALUE),
            F.filter(F.regexp_extract_all(word, F.lit(VALUE), F.lit(0)), lambda x: x.rlike("[0-9]")),
        ).otherwise(none)
        inside = F.when(word.rlike("[=:]"), F.regexp_extract_all(word, F.lit(f"{KEY}[=:]+{QUOTES}({ASSIGNED})"), F.lit(1))).otherwise(none)
        by_words = before.rlike("[=:]$|^=>$") & F.when(before.rlike("^(?:[=:]+|=>)$"), before2.rlike(f"{KEY}$")).otherwise(before.rlike(f"{KEY}[=:]+$"))
        behind = F.when(by_words, F.array(F.regexp_extract(word, f"^{QUOTES}({ASSIGNED})", 1))).otherwise(none)
        assigned = F.filter(
            F.concat(inside, behind),
            lambda x: (x != "") & ~F.exists(long, lambda run: (run == x) | run.endswith(F.concat(F.lit("="), x))),
        )
        names = {"place": i.cast("long"), "word": word, "before2": before2, "before": before, "after": after, "values": F.array_union(long, assigned)}
        return F.struct(*(c.alias(n) for n, c in names.items()))

    hits = F.filter(F.transform("words", found), lambda x: F.size(x["values"]) > 0)
    out = rows.select("doc_id", F.explode(hits).alias("c")).select("doc_id", "c.*")
    return out.withColumn("value", F.explode("values")).drop("values")


def with_features(found: DataFrame) -> DataFrame:
    """Adds ``FEATURES``: length, character classes and transitions, dictionary coverage, path marks and neighbouring words."""
    value, lower = F.col("value"), F.lower("value")
    pieces = "(?:" + "|".join(sorted(PIECES, key=lambda p: (-len(p), p))) + ")"
    plain = "^[\\p{L}]{1,25}[.,;:!?]?$"
    columns = {
        "n_chars": F.length(value).cast("double"),
        "digit_share": _share(value, "[0-9]"),
        "upper_share": _share(value, "[A-Z]"),
        "lower_share": _share(value, "[a-z]"),
        "other_share": _share(value, "[+/_=-]"),
        "hex_share": _share(value, "[0-9a-fA-F]"),
        "transitions": _share(value, "[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])"),
        "switches_case": _share(value, "[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        "repeats": _share(value, "(.)(?=\\1)"),
        "dictionary": 1 - F.length(F.regexp_replace(lower, pieces, "")) / F.length(value),
        "quoted": F.col("word").rlike("[\"'`]").cast("double"),
        "assigned": (F.col("before").rlike("[=:]$") | F.col("word").rlike("^[A-Za-z_-]+[=:][^=]")).cast("double"),
        "key_before": F.lower(F.concat_ws(" ", "before2", "before", "word")).rlike(KEY_NAMES).cast("double"),
        "path_like": F.col("word").rlike("[/\\\\].*[/\\\\]|\\.[a-z]{2,4}$").cast("double"),
        "url_like": F.col("word").rlike("://|@|www\\.").cast("double"),
        "plain_before": F.col("before").rlike(plain).cast("double"),
        "plain_after": F.col("after").rlike(plain).cast("double"),
    }
    return found.withColumns({name: F.coalesce(c.cast("double"), F.lit(0.0)) for name, c in columns.items()})


def labelled_by_form(found: DataFrame) -> DataFrame:
    """Labels of the candidates whose form tells what they are: 1 a secret, 0 none; null for all others.

    Secrets: strings of the fixed formats of issued keys, wherever they stand, and what is assigned to a key name and is neither words,
    nor digits, nor a path.  No secrets: numbers, UUIDs, words, parts of paths and addresses, and digests that no key name goes with.
    """
    value = F.col("value")
    issued = value.rlike(ISSUED) | (value.rlike(TOKEN_PART) & F.col("word").rlike(TOKEN))
    named = (F.col("key_before") > 0) & (F.col("assigned") > 0)
    assigned = named & (F.col("digit_share") < 1) & (F.col("dictionary") < 0.5) & (F.col("path_like") == 0)
    plain = (F.col("digit_share") == 1) | value.rlike(UUID) | (F.col("dictionary") >= 0.5) | (F.col("path_like") > 0) | (F.col("url_like") > 0)
    digest = value.rlike(DIGEST) & (F.col("key_before") == 0)
    label = F.when(issued | assigned, 1.0).when(plain | digest, 0.0)
    return found.withColumn("label", label)


def made_findings(spark: SparkSession, rows: int = MADE_FINDINGS) -> DataFrame:
    """Labelled findings of the public formats and of what is mistaken for them, made from digests of numbers.

    They stand in for the reviewed findings that a corpus lacks, so that a format that it has never shown is known all the same.
    ``rows`` sentences of ten kinds in turn; a bound, whatever the corpus.
    """
    digest = F.sha2(F.col("id").cast("string"), 256)
    mixed = F.regexp_replace(F.concat(F.base64(F.unhex(digest)), F.base64(F.unhex(F.sha2(digest, 256)))), "[+/=]", "")
    digits = F.lpad(F.conv(F.substring(digest, 1, 13), 16, 10), 16, "7")
    capitals = F.concat(F.substring(F.upper(mixed), 1, 13), F.substring(digits, 1, 3))
    uuid = F.concat_ws("-", *[F.substring(digest, i, n) for i, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    year = (F.col("id") % 30 + 1995).cast("string")
    kinds = [
        (1.0, F.concat(F.lit("AKIA"), capitals)),
        (1.0, F.concat(F.lit("ghp_"), F.substring(mixed, 1, 36))),
        (1.0, F.concat(F.lit("eyJhbGciOiJIUzI1NiJ9.eyJ"), F.substring(mixed, 1, 40), F.lit("."), F.substring(mixed, 30, 43))),
        (1.0, F.concat(F.lit("password = \""), F.substring(digest, 1, 32), F.lit("\""))),
        (1.0, F.concat(F.lit("api_key: "), F.substring(mixed, 1, 40))),
        (0.0, digits),
        (0.0, uuid),
        (0.0, F.concat(F.lit("https://example.org/commit/"), F.substring(digest, 1, 40))),
        (0.0, F.concat(F.lit("/var/www/html/page-"), digits, F.lit("/index.html"))),
        (0.0, F.concat(F.element_at(F.array(*map(F.lit, ("user_account_settings_", "getCustomerAddressList", "monthly-report-summary-"))), (F.col("id") % 3 + 1).cast("int")), year)),
    ]
    text, label = F.lit(None).cast("string"), F.lit(None).cast("double")
    for i, (known, value) in enumerate(kinds):
        kind = F.col("id") % len(kinds) == i
        text, label = F.when(kind, value).otherwise(text), F.when(kind, F.lit(known)).otherwise(label)
    before = F.element_at(F.array(*map(F.lit, ("see", "here is", "value", "we found"))), (F.floor(F.col("id") / 10) % 4 + 1).cast("int"))
    texts = spark.range(rows).select(F.col("id").alias("doc_id"), F.concat_ws(" ", before, text, F.lit("and more words")).alias("text"), label.alias("label"))
    return with_features(candidates(texts)).join(texts.select("doc_id", "label"), "doc_id")


def training_rows(labelled: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """(FEATURES, label, weight): at most half of ``rows`` distinct vectors of each label, chosen by hash; the weight counts a vector's findings."""
    vectors = labelled.where("label is not null").groupBy(*FEATURES, "label").agg(F.count("*").cast("double").alias("weight"))

    def some(of_kind: Column) -> DataFrame:
        return vectors.where(of_kind).orderBy(F.xxhash64(*FEATURES), *FEATURES).limit(rows // 2)

    return some(F.col("label") > 0).union(some(F.col("label") <= 0))


def fitted(labelled: DataFrame, rows: int = TRAINING_ROWS):
    """A random forest over ``training_rows``, which have both kinds if the labelled findings do; None if those have one kind."""
    chosen = stage(training_rows(labelled, rows), "secret-training")
    kinds = chosen.agg(F.count_distinct("label")).first()[0]
    if kinds < 2:
        return None
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird"
    )
    return forest.fit(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(chosen))


def scored(found: DataFrame, model) -> DataFrame:
    """Adds ``score`` (0 to 1) and ``secret``.  Without a model every candidate stays, with score 1."""
    if model is None:
        return found.withColumn("score", F.lit(1.0)).withColumn("secret", F.lit(True))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)
    out = model.transform(vectors).withColumn("score", F.round(vector_to_array("probability")[1], 6))
    return out.withColumn("secret", F.col("score") >= THRESHOLD)


def scan_secrets(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """(doc_id, place, value, n_chars, score, secret) of every candidate in every whole text.

    ``labelled`` holds reviewed findings (columns ``FEATURES`` and ``label``); without it they are the corpus's own strings whose form
    tells what they are (``labelled_by_form``) and made ones (``made_findings``).  ``place`` is the word number.

    Needs ``doc_id`` and ``text``; others are left out.  Null and empty texts have no candidates.  Ids pass on as they
    are, null or repeated; repeated rows give repeated findings.
    """
    found = stage(with_features(candidates(docs)), "secret-candidates")
    if labelled is None:
        own = [*FEATURES, "label"]
        labelled = labelled_by_form(found).select(own).union(made_findings(docs.sparkSession).select(own))
    model = fitted(labelled)
    return scored(found, model).select("doc_id", "place", "value", F.col("n_chars").cast("long").alias("n_chars"), "score", "secret")
