"""Secret scans: candidates, features and a random forest, with DataFrame functions only.

A candidate is a run of ``MIN_LENGTH`` or more letters, digits and ``+/_-`` in a
word, or a value of any length and any characters but blanks that a name like
"password" stands beside: assigned to it, or, if it has letters and digits, right
after it.  Its features: length, shares of character classes, transitions between
classes, spread of its characters, the share covered by word parts and by a
dictionary of the corpus (whole words by document frequency), how it begins,
signs of a path around it, and the words before it (an assignment, a quote, a
key word, a word for a checksum or an id, a word for an example).  A random
forest trained on labelled findings tells secrets from false positives; its
score alone decides.

Labelled findings are a parameter: (id, word_index, part, label).  Where a
corpus brings none, the forest learns from ``secret_examples``: texts whose label
is known by how they were made.  Findings name rows by id, so rows that repeat
an id share them, and a null id names rows with a null id; where findings
contradict each other the more frequent label counts (a tie: 1).  Training takes
``MAX_FINDINGS`` findings at most in the mean, half of them of each label, drawn by a
hash; the dictionary has ``DICTIONARY_WORDS`` words at most; scanning and document
frequencies cover all whole texts.

Defined results: null and empty texts have no candidates; without a labelled
secret nothing is reported, with secrets only everything is; rows that repeat an
id are scanned each; other columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import materialise, read_table
from sluice.llm.mixing import draw
from sluice.llm.secret_examples import labelled_examples

MIN_LENGTH = 16
MAX_FINDINGS = 4000
TREES, DEPTH = 40, 9
DICTIONARY_WORDS, LEAST_DOCS = 20_000, 3
THRESHOLD = 0.5
_RUN = rf"[A-Za-z0-9+/_\-]{{{MIN_LENGTH},}}"
_KEYS = r"(?i)(token|secret|passw|passphrase|pwd|api.?key|access.?key|auth|credential|bearer)"
_NAME = (r"(?i:token|secret(?:[_\-]?access)?(?:[_\-]?key)?|passwor[dt]|passwd|passphrase|\bpass|pwd|"
         r"(?:api|access|auth|private|secret)[_\-]?key|credentials?|bearer)")
_ASSIGN = r"[\"'\]]*\s*(?::=|=>|[:=])\s*"
# A quoted value goes to its quote, another to a separator before the next name or at the word's end.
_VALUE = r"""(?:"([^"]+)|'([^']+)|((?:[^"'&;,]|[&;,](?!\w*[:=]|$))+))"""
#: How the keys and tokens of providers begin.
LEADS = (r"^(?:A[KS]IA[0-9A-Z]|gh[pousr]_|github_pat_|glpat-|[srp]k_(?:live|test)_|xox[abeoprs]-|AIza|npm_|pypi-|hf_|dop_v1_|sk-|"
         r"shp(?:at|ca|pa|ss)_|eyJ)")
_IDS = r"(?i)(commit|revision|sha\d*|md5|checksum|digest|hash|etag|integrity|uuid|guid|\bids?\b|tree/|object|base64|ssh-rsa|order|card|serial)"
_SAMPLE = r"(?i)(example|sample|dummy|placeholder|your|changeme|xxxx|\*\*\*|todo|<|\$\{|\.\w+\.|environ|config|self\.|getpass)"
#: Frequent words and word parts of English, French, German and Spanish texts and of code.
DICTIONARY = (
    "the and ing tion ment que ent ver ung lich keit heit sch ein der die das und los las por con ado ción mente "
    "eau oir ais est les des pour avec dans with from this that have are was her his able ness less ful ous ive "
    "user name file path data test example sample value index config default admin public private local home temp "
    "http https www com org net html json image video document version license system service server client").split()


def _values() -> Column:
    """The values of a word that a name like "password" stands beside, as an array."""
    word, one, two = F.col("word"), F.col("before1"), F.col("before2")
    last = rf"{_NAME}[\"'\]]*$"
    link = one.rlike(r"^(?::=|=>|[:=])$") & two.rlike(last)
    after = one.rlike(_NAME + _ASSIGN + "$") | link
    value = lambda x, lead: F.concat(*[F.regexp_extract(x, lead + _VALUE, k) for k in (1, 2, 3)])
    inside = F.transform(F.regexp_extract_all("word", F.lit(_NAME + _ASSIGN + _VALUE), F.lit(0)),
                         lambda x: value(x, "^" + _NAME + _ASSIGN))
    beside = one.rlike(last) | (F.lower(one).isin("is", "was", "ist", "est", "es") & two.rlike(last))
    mixed = word.rlike("[0-9]") & word.rlike("[A-Za-z]") & ~word.rlike(_NAME)
    found = F.concat(inside, F.array(
        F.when(after, value(word, "^")).when(one.rlike(last) & word.rlike(r"^(?::=|=>|[:=])."), value(word, "^(?::=|=>|[:=])"))
        .when(beside & mixed, value(word, r"^[(\[]?"))))
    found = F.transform(found, lambda x: F.regexp_replace(x, r"[.,;:)\]}]+$", ""))
    # Runs are candidates already.
    return F.array_distinct(F.filter(found, lambda x: (x != "") & ~x.rlike(f"^{_RUN}=*$") & ~x.rlike("^[:=>]+$")))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per candidate: key, word_index, part, core, prefix, suffix, before (up to three words), after.

    ``part`` counts the runs of a word from 0, and its values beside a name from -1 downwards.
    """
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    rows = rows.withColumn("named", F.col("text").rlike(_NAME)).where(F.col("named") | F.col("text").rlike(_RUN))
    rows = rows.select("key", "named", F.split("text", r"[\x20\x09-\x0D]+").alias("words"))
    word = lambda i: F.get("words", i)
    hits = F.filter(F.sequence(F.lit(0), F.size("words") - 1),
                    lambda i: ((F.length(word(i)) >= MIN_LENGTH) & word(i).rlike(_RUN))
                    | (F.col("named") & (F.coalesce(word(i).rlike(_NAME) | word(i - 1).rlike(_NAME), word(i).rlike(_NAME))
                                         | F.coalesce(word(i - 2).rlike(_NAME), F.lit(False)))))
    rows = rows.select("key", "named", "words", F.explode(hits).alias("at"))
    at = F.col("at")
    near = [F.coalesce(F.when(at >= k, word(at - k)), F.lit("")) for k in (3, 2, 1)]
    rows = rows.select("key", "named", at.alias("word_index"), word(at).alias("word"), F.concat_ws(" ", *near).alias("before"),
                       near[2].alias("before1"), near[1].alias("before2"), F.coalesce(word(at + 1), F.lit("")).alias("after"))
    runs = F.transform(F.regexp_extract_all("word", F.lit(_RUN), F.lit(0)),
                       lambda x, i: F.struct(i.alias("part"), x.alias("core"), (F.instr("word", x) - 1).alias("left")))
    values = F.transform(_values(), lambda x, i: F.struct(
        (-1 - i).alias("part"), x.alias("core"), F.greatest(*[F.instr("word", F.concat(F.lit(c), x)) for c in "=:>\"'"]).alias("left")))
    none = F.array().cast("array<struct<part:int,core:string,left:int>>")
    rows = rows.withColumn("found", F.explode(F.concat(runs, F.when(F.col("named"), values).otherwise(none))))
    rows = rows.select("key", "word_index", "found.*", "word", "before", "after")
    return rows.select("key", "word_index", "part", "core", F.expr("left(word, `left`)").alias("prefix"),
                       F.expr("substring(word, `left` + 1 + length(core))").alias("suffix"), "before", "after")


FEATURES = ["length", "digits", "uppers", "lowers", "signs", "hex", "vowels", "changes", "spread", "known", "words", "lead", "path",
            "assigned", "quoted", "key_near", "key_before", "id_near", "sample"]


def with_features(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Candidates with their features; ``dictionary``: a table of at most ``DICTIONARY_WORDS`` words."""
    core, n = F.col("core"), F.length("core").cast("double")
    share = lambda pattern: F.regexp_count(core, F.lit(pattern)) / n
    left = F.concat_ws(" ", "before", "prefix")
    known = F.regexp_replace(F.lower(core), "(" + "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w))) + ")", "")
    flag = lambda c: c.cast("double")
    # A candidate's word parts are looked up in the dictionary, which is small enough to be sent to every task.
    pieces = F.regexp_extract_all(F.regexp_replace(core, "([a-z])([A-Z])", "$1 $2"), F.lit("[A-Za-z]{4,}"), F.lit(0))
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "secrets-rows")
    covered = (rows.select("row", F.explode(pieces).alias("piece"))
               .join(F.broadcast(dictionary.limit(DICTIONARY_WORDS)), F.lower("piece") == F.col("word"), "left_semi")
               .groupBy(F.col("row").alias("of")).agg(F.sum(F.length("piece")).alias("covered")))
    rows = (rows.join(covered, F.col("row") == F.col("of"), "left")
            .withColumn("words", F.coalesce(F.col("covered"), F.lit(0)) / n).drop("row", "of", "covered"))
    return rows.select("*", *[c.alias(name) for name, c in zip([f for f in FEATURES if f != "words"], [
        F.log(n), share("[0-9]"), share("[A-Z]"), share("[a-z]"), share(r"[+/_\-]"), share("[0-9a-f]"),
        share("[aeiouAEIOU]"), share("[a-z](?![a-z])|[A-Z](?![A-Z])|[0-9](?![0-9])"),
        F.size(F.array_distinct(F.split(core, ""))) / F.least(n, F.lit(64.0)), 1 - F.length(known) / n,
        flag(core.rlike(LEADS) | F.col("prefix").rlike(r"eyJ[A-Za-z0-9_\-]+\.$")),
        flag(core.rlike("/.*/") | F.col("prefix").rlike(r"[/\\]|^\w+:$") | F.col("suffix").rlike(r"^\.[A-Za-z0-9]{1,5}\b")),
        flag(left.rlike(r"[:=]\s*[\"']?$")), flag(F.col("prefix").rlike("[\"']$")),
        flag(F.col("prefix").rlike(_KEYS)), flag(F.col("before").rlike(_KEYS)),
        flag(left.rlike(_IDS)), flag(core.rlike(_SAMPLE) | F.col("suffix").rlike(r"^[(\[]"))], strict=True)])


def corpus_dictionary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word): the ``DICTIONARY_WORDS`` words of four or more letters that stand in the most texts, in ``LEAST_DOCS`` at least.

    Whole words between blanks and points only, so that parts of keys do not become words.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"(?<![^\s.,;:!?])[a-z]{4,}(?![^\s.,;:!?])"), F.lit(0)))
    return (docs.select(F.explode(words).alias("word")).groupBy("word").count().where(F.col("count") >= LEAST_DOCS)
            .orderBy(F.desc("count"), "word").limit(DICTIONARY_WORDS).select("word"))


def train(findings: DataFrame, max_findings: int = MAX_FINDINGS):
    """A forest for (features, label, key, word_index, part) rows; a constant score where only one label occurs."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    counts = {r["label"]: r["count"] for r in findings.groupBy("label").count().collect()}
    if len(counts) < 2:
        return float(max(counts, default=0.0))
    share = F.when(F.col("label") > 0.5, F.lit(max_findings / 2 / counts[1.0])).otherwise(F.lit(max_findings / 2 / counts[0.0]))
    drawn = draw("secrets", F.col("key"), F.col("word_index"), F.col("part"))
    sample = findings.where(drawn < share).select("label", *FEATURES)
    sample = materialise(sample.repartition(1).sortWithinPartitions("label", *FEATURES), "secrets-sample")
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7, featuresCol="features",
                                  labelCol="label").fit(data)


def score(rows: DataFrame, model) -> DataFrame:
    """Rows with features -> a column ``score``, the forest's share for a secret."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    if isinstance(model, float):
        return rows.withColumn("score", F.lit(model))
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    return model.transform(data).withColumn("score", vector_to_array("probability")[1])


def example_findings(spark, dictionary: DataFrame, each: int | None = None) -> DataFrame:
    """The labelled examples as candidates with features; candidates beside an example's value are left out."""
    texts = materialise(labelled_examples(spark) if each is None else labelled_examples(spark, each), "secrets-texts")
    rows = with_features(candidates(texts, "id", "text"), dictionary)
    return (rows.join(texts.select(F.col("id").alias("of"), "value", "label"), F.col("key") == F.col("of"))
            .where(F.col("value").contains(F.col("core"))).drop("of", "value"))


def scan_secrets(docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD) -> DataFrame:
    """One row per secret: id, word_index, part, secret, score.

    ``findings``: labelled candidates (id, word_index, part, label 0 or 1).
    """
    spark = docs.sparkSession
    dictionary = materialise(corpus_dictionary(docs, text_col), "secrets-dictionary")
    rows = materialise(with_features(candidates(docs, id_col, text_col), dictionary), "secrets-candidates")
    if findings is None:
        labelled = materialise(example_findings(spark, dictionary), "secrets-examples")
    else:
        named = (findings.groupBy(F.col(id_col).alias("of"), F.col("word_index").alias("at"), F.col("part").alias("nth"))
                 .agg((F.avg(F.col("label").cast("double")) >= 0.5).cast("double").alias("label")))
        labelled = rows.join(named, F.col("key").eqNullSafe(F.col("of")) & (F.col("word_index") == F.col("at"))
                             & (F.col("part") == F.col("nth"))).drop("of", "at", "nth")
    found = score(rows, train(labelled)).where(F.col("score") >= threshold)
    return found.select(F.col("key").alias(id_col), "word_index", "part", F.col("core").alias("secret"), "score")


def op4_query(spark, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "word_index", "part", F.sha2("secret", 256).alias("secret_sha256"), "score")
