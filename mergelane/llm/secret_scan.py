"""Secret scans: candidates by pattern, and a random forest that removes false positives.

Candidates are all parts of a text's words that look like keys: known formats, values that a keyword assigns, and
long mixed strings. The forest judges them by length, character transitions, share covered by
dictionary words, path and neighbouring words; it is trained on labelled findings. All of it is
DataFrame work: texts without anything like a candidate are passed by with one pattern.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergelane.session import materialize

# A run of key characters, a JSON web token, and the last of either in a word (by which the tests read words of one value).
_RUN = r"[A-Za-z0-9+/_-]{8,}={0,2}"
_JWT = r"eyJ[A-Za-z0-9_-]{6,}\.eyJ[A-Za-z0-9_.-]{5,}[A-Za-z0-9_-]"
_VALUE = rf"({_JWT}|{_RUN})[^A-Za-z0-9+/_=-]*$"
_KEYWORDS = r"pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth"
_KEYED = rf"(?i)(?:{_KEYWORDS})[A-Za-z0-9_-]{{0,20}}[\"']?\s*(?:=|:|=>)\s*[\"']?[A-Za-z0-9+/_-]{{8,}}={{0,2}}[^A-Za-z0-9+/_=-]*$"
# A keyword with its sign of assignment and an opening quote.
_NAMED = rf"(?:{_KEYWORDS})[A-Za-z0-9_-]{{0,20}}[\"']?"
_LEAD = rf"{_NAMED}\s*(?:=>|={{1,3}}|:=?)\s*[\"']?"
# What is assigned: behind a quote all up to a quote or blank, else also up to the next assignment (&a=, ;a=, ,a:).
_ASSIGNED = r"(?<=[\"'])[^\s\"'`]++|(?:[^\s\"'`&;,]|[&;,](?![A-Za-z0-9_.-]{1,64}[=:]|[\"']))++"
_SHAPES = (
    r"(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{10,}"
    rf"|sk[-_][A-Za-z0-9_-]{{20,}}|AIza[A-Za-z0-9_-]{{30,}}|{_JWT}"
)
# What a text must hold to be looked at word by word.
_ANY = (
    r"[0-9][A-Za-z0-9+/_-]{5}|[A-Za-z0-9+/_-]{6}[0-9]|[:=][\"'\s]{0,3}[A-Za-z0-9+/_-]{8}"
    rf"|(?i:{_NAMED})\s*[=:]|(?<![A-Za-z0-9])(?:{_SHAPES})"
)
_FORMATS = rf"^(?:{_SHAPES})$"
# What is taken out of a word, in this order; group 1 is the value.
_PARTS = (
    ("format", rf"(?<![A-Za-z0-9])({_SHAPES})"),
    ("keyed", rf"(?i:{_LEAD})({_ASSIGNED})"),
    ("run", rf"[\"'`]?({_RUN})"),
)
_DOUBTS = (
    r"(?i)example|dummy|sample|placeholder|your|uuid|sha\d*|hash|commit|checksum|version|isbn|phone|order"
    r"|md5|digest|revision|build|invoice|ticket"
)
# Shapes of what is no key: uuids, numbers in groups, words and numbers in a path or slug; and digests, next to a doubt.
_HARMLESS = (
    r"^(?:[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9]+(?:[-_/+][0-9]+)*=?"
    r"|/*(?:[a-z]{2,}|[A-Z]?[a-z]+|[0-9]{1,8}|v?[0-9]{1,4}|rc[0-9])(?:[-_/]+(?:[A-Z]?[a-z]+|[0-9]{1,8}|v[0-9]{1,4}|rc[0-9]))+/*)$"
)
_DIGEST = r"^(?:[0-9a-f]{7,16}|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})$"
_TEST_PATH = r"(?i)test|example|sample|mock|fixture|docs?\b"
_CONFIG_PATH = r"(?i)conf|env|settings|secret|deploy|\.ya?ml|\.json|\.properties|\.ini"

# Characters of the words around a candidate that its features see; of a longer word, they see the candidate only.
CONTEXT = 200
# Words of the corpus that occur this often are the dictionary.
DICTIONARY_MIN = 20
# Labelled findings of each class that a forest is trained on, at most.
TRAIN_ROWS = 5_000
# One in this many plain words of a text with candidates becomes a labelled finding of class 0.
PLAIN_SHARE = 64
THRESHOLD = 0.5

FEATURES = (
    "length", "digits", "upper", "symbols", "letter_digit", "digit_letter", "lower_upper", "vowel_consonant", "same",
    "dictionary", "path_depth", "path_test", "path_config", "keyed", "keyword_near", "doubt_near", "quoted", "prose_after",
)


def _word(words: Column, i: Column) -> Column:
    """words[i], empty outside of the array."""
    return F.when((i >= 0) & (i < F.size(words)), F.element_at(words, F.greatest(i, F.lit(0)).cast("int") + 1)).otherwise("")


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """One row per candidate: the id, ``at`` (word number), ``part`` (number in the word), rule, value, and its
    surroundings (word, before, after, path).

    Rules: ``format`` (the shape of a known key), ``keyed`` (assigned by a keyword), ``mixed`` (12
    characters or more with a digit), and ``plain``: a hash sample of letter-only words, which are no
    candidates but labelled findings to train with. Null and empty texts have none. Whole texts are
    read, and all of each word: first its formats, then its assigned values of any characters and length (a quoted
    one ends at a blank, an unquoted one loses closing punctuation), then the runs of key characters that are left. Rows stay apart by (id, at, part), and repeated rows repeat theirs.
    """
    path = F.coalesce(docs[path_col].cast("string"), F.lit("")) if path_col else F.lit("")
    hit = docs.select(docs[id_col].alias("id"), path.alias("path"), docs[text_col].alias("text")).filter(
        F.col("text").rlike(_ANY)
    )
    split = hit.select("id", "path", F.split("text", r"\s+").alias("words"))

    def place(i: Column) -> Column:
        before = F.concat_ws(" ", _word(F.col("words"), i - 2), _word(F.col("words"), i - 1))
        return F.struct(
            i.cast("long").alias("at"), F.element_at("words", i + 1).alias("word"),
            F.substring(before, -CONTEXT, CONTEXT).alias("before"),
            F.substring(_word(F.col("words"), i + 1), 1, CONTEXT).alias("after"),
        )

    def looked_at(i: Column) -> Column:
        word = F.element_at("words", i + 1)
        last = F.substring(_word(F.col("words"), i - 1), -1, 1)
        return (F.length(word) >= 8) | word.contains("=") | word.contains(":") | last.isin("=", ":", ">", '"', "'")

    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), looked_at)
    words = split.select("id", "path", F.explode(F.transform(places, place)).alias("w")).select("id", "path", "w.*")
    # An assignment that begins in the words before is written in front of the word in short.
    word, before = F.col("word"), F.col("before")
    parts = words.withColumn(
        "rest",
        F.when(before.rlike(rf"(?i){_LEAD}$"), F.concat(F.lit("pwd="), word))
        .when(word.rlike("^[=:]") & before.rlike(rf"(?i){_NAMED}$"), F.concat(F.lit("pwd"), word))
        .otherwise(word),
    )
    for rule, pattern in _PARTS:
        found = F.zip_with(
            F.regexp_extract_all("rest", F.lit(pattern), F.lit(0)),
            F.regexp_extract_all("rest", F.lit(pattern), F.lit(1)),
            lambda m, v: F.struct(F.lit(rule).alias("rule"), m.alias("match"), v.alias("value")),  # noqa: B023
        )
        parts = parts.withColumn(rule, found).withColumn("rest", F.regexp_replace("rest", pattern, '""'))
    # The rows of a long word do not repeat it: it may hold thousands of candidates.
    cut = parts.select(
        "id", "path", "at", F.when(F.length(word) <= CONTEXT, word).alias("word"), "before", "after",
        F.concat(*[rule for rule, _ in _PARTS]).alias("parts"),
    )
    each = cut.select("id", "path", "at", "word", "before", "after", F.posexplode("parts").alias("part", "p"))
    given, whole = F.col("p.value"), F.col("p.match")
    bare = (F.col("p.rule") == "keyed") & ~whole.substr(F.length(whole) - F.length(given), F.lit(1)).isin('"', "'")
    value = F.when(bare, F.regexp_replace(given, r"[,;.:)\]}>]+$", "")).otherwise(given)
    long = (F.length(value) >= 12) & value.rlike("[0-9]")
    plain = value.rlike("^[A-Za-z]+$") & (F.pmod(F.xxhash64(value), F.lit(PLAIN_SHARE)) == 0)
    rule = F.when(F.col("p.rule") != "run", F.when(value != "", F.col("p.rule"))).when(long, "mixed").when(plain, "plain")
    return each.select(
        F.col("id").alias(id_col), "path", "at", F.col("part").cast("long").alias("part"), rule.alias("rule"),
        value.alias("value"), F.coalesce("word", "p.match").alias("word"), "before", "after",
    ).filter(F.col("rule").isNotNull())


def dictionary(docs: DataFrame, text_col: str = "text", least: int = DICTIONARY_MIN) -> DataFrame:
    """word: lower-case runs of 3 to 15 letters a-z that stand in the corpus at least `least` times."""
    words = docs.select(F.explode(F.split(F.lower(F.col(text_col)), "[^a-z]+")).alias("word"))
    sized = words.filter(F.length("word").between(3, 15))
    return sized.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).select("word")


def _coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """value, covered: characters of the value's letter runs that are dictionary words."""
    runs = found.select("value").distinct().select(
        "value", F.explode(F.split(F.lower("value"), "[^a-z]+")).alias("word")
    ).filter(F.length("word") >= 3)
    return runs.join(words, "word").groupBy("value").agg(F.sum(F.length("word")).alias("covered"))


def featured(found: DataFrame, words: DataFrame) -> DataFrame:
    """`found` (from `findings`) with a column for each of FEATURES; null values count as empty ones."""
    value = F.coalesce("value", F.lit(""))
    size = F.greatest(F.length(value), F.lit(1)).cast("double")
    pairs = F.greatest(F.length(value) - 1, F.lit(1)).cast("double")
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern))
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    context = F.concat_ws(" ", "before", "word")
    lead = F.concat_ws(" ", "before", F.call_function("substring_index", F.col("word"), value, F.lit(1)))
    columns = {
        "length": F.length(value).cast("double"),
        "digits": count(value, "[0-9]") / size,
        "upper": count(value, "[A-Z]") / size,
        "symbols": count(value, "[^A-Za-z0-9]") / size,
        "letter_digit": count(value, "[A-Za-z](?=[0-9])") / pairs,
        "digit_letter": count(value, "[0-9](?=[A-Za-z])") / pairs,
        "lower_upper": count(value, "[a-z](?=[A-Z])") / pairs,
        "vowel_consonant": count(F.lower(value), "[aeiou](?=[b-df-hj-np-tv-z])") / pairs,
        "same": count(value, r"(.)(?=\1)") / pairs,
        "dictionary": F.coalesce(F.col("covered"), F.lit(0)) / size,
        "path_depth": (F.size(F.split("path", "/")) - 1).cast("double"),
        "path_test": yes(F.col("path").rlike(_TEST_PATH)),
        "path_config": yes(F.col("path").rlike(_CONFIG_PATH)),
        "keyed": yes(lead.rlike(rf"(?i){_LEAD}$")),
        "keyword_near": yes(context.rlike(rf"(?i)\b(?:{_KEYWORDS})\b")),
        "doubt_near": yes(F.concat_ws(" ", "before", "after").rlike(_DOUBTS)),
        "quoted": yes(F.col("word").rlike("[\"'`]")),
        "prose_after": yes(F.col("after").rlike("^[a-z]+[,.;]?$")),
    }
    covered = found.join(_coverage(found, words), "value", "left")
    return covered.withColumns(columns).drop("covered")


def format_labels(found: DataFrame) -> DataFrame:
    """Featured findings with ``label``, where shape and neighbours tell: 1 for known formats and for assigned long values with
    digits, 0 for plain words and for candidates that no keyword assigns and that are uuids, grouped numbers, slugs, digests next to
    a word such as commit or checksum, or anything in a test path; else null. For use where nobody has labelled findings.

    Findings of class 1 come once more without what surrounds them, so that the forest learns what keys look like, too.
    """
    sure = (F.col("rule") == "format") | (
        (F.col("rule") == "keyed") & (F.length("value") >= 16) & (F.regexp_count("value", F.lit("[0-9]")) >= 4)
        & ~F.col("value").rlike(_HARMLESS)
    )
    value = F.col("value")
    doubted = value.rlike(_HARMLESS) | (value.rlike(_DIGEST) & (F.col("doubt_near") == 1)) | (F.col("path_test") == 1)
    harmless = (F.col("rule") == "plain") | ((F.col("rule") == "mixed") & (F.col("keyed") == 0) & doubted)
    known = found.withColumn("label", F.when(sure, 1.0).when(harmless, 0.0))
    bare = dict.fromkeys(("keyed", "keyword_near", "quoted", "prose_after", "path_config", "path_depth"), F.lit(0.0))
    return known.unionByName(known.filter("label = 1").withColumns(bare))


@dataclass(frozen=True)
class Forest:
    """A trained forest, or none if the labelled findings held only one class."""

    model: object | None
    features: tuple[str, ...] = FEATURES


def train(labelled: DataFrame, rows: int = TRAIN_ROWS, trees: int = 20, depth: int = 6, seed: int = 17) -> Forest:
    """A random forest from featured findings with ``label`` (0 or 1; null ones are left out).

    At most `rows` findings of each class are used, the first by a hash of value and surroundings; distinct ones only.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    known = labelled.filter("label IS NOT NULL").select(F.col("label").cast("double"), *FEATURES)
    order = F.xxhash64(*FEATURES)
    classes = [known.filter(F.col("label") == c).distinct().orderBy(order, *FEATURES).limit(rows) for c in (0.0, 1.0)]
    # One partition of at most 2 * rows: the trees' samples then do not depend on how findings are spread.
    sample = materialize(classes[0].unionByName(classes[1]).coalesce(1), "forest")
    if sample.select("label").distinct().count() < 2:
        return Forest(None)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird")
    return Forest(forest.fit(vectors.select("label", "features")))


def judged(found: DataFrame, forest: Forest) -> DataFrame:
    """Featured candidates with ``score`` (0 to 1) and ``secret``; plain words go.

    Without a forest the rule decides: known formats and assigned values score 1, the rest 0.
    """
    candidates = found.filter("rule <> 'plain'")
    if forest.model is None:
        scored = candidates.withColumn("score", F.when(F.col("rule").isin("format", "keyed"), 1.0).otherwise(0.0))
    else:
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.functions import vector_to_array

        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="__features").transform(candidates)
        model = forest.model.copy({
            forest.model.featuresCol: "__features", forest.model.probabilityCol: "__probability",
            forest.model.rawPredictionCol: "__raw", forest.model.predictionCol: "__prediction",
        })
        scored = model.transform(vectors).withColumn("score", vector_to_array("__probability")[1]).drop(
            "__features", "__probability", "__raw", "__prediction"
        )
    return scored.withColumn("secret", F.col("score") >= THRESHOLD)


def scan(
    docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
    path_col: str | None = "source",
) -> DataFrame:
    """One row per candidate: id, at, part, rule, value, score, secret (see `findings`, `judged`).

    `labelled`: findings (columns of `findings`) with a label; without them, `format_labels` of the
    corpus' own findings serve. The dictionary comes from the whole corpus. An empty table, or one
    without candidates, gives no rows. Extra columns of `docs` do not matter.
    """
    found = materialize(findings(docs, id_col, text_col, path_col), "findings")
    words = materialize(dictionary(docs, text_col), "dictionary")
    all_featured = materialize(featured(found, words), "featured")
    labels = format_labels(all_featured) if labelled is None else featured(labelled, words)
    return judged(all_featured, train(labels)).select(id_col, "at", "part", "rule", "value", "score", "secret")


def redact(docs: DataFrame, secrets: DataFrame, mark: str = "[SECRET]", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the values of `secrets` (id, value) replaced in the texts of that id; all else stays.

    Texts that hold nothing like a candidate are not shuffled. Longer values are replaced first; those of
    less than 8 characters only where a keyword assigns them, as they may be parts of common words.
    """
    values = secrets.groupBy(F.col(id_col).alias("__id")).agg(
        F.sort_array(F.collect_set(F.struct(F.length("value").alias("n"), "value")), asc=False).alias("__values")
    )
    text = F.col(text_col)
    may = F.coalesce(text.rlike(_ANY), F.lit(False))
    literal = lambda v: F.concat(F.lit("\\Q"), F.replace(v, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    named = lambda v: F.concat(F.lit(rf"((?i:{_LEAD}))"), literal(v), F.lit("(?![A-Za-z0-9])"))
    marked = F.lit("$1" + mark.replace("\\", "\\\\").replace("$", "\\$"))
    clean = F.aggregate(
        "__values", text,
        lambda t, v: F.when(v["n"] < 8, F.regexp_replace(t, named(v["value"]), marked)).otherwise(
            F.replace(t, v["value"], F.lit(mark))
        ),
    )
    hit = docs.filter(may).join(values, F.col(id_col).eqNullSafe(F.col("__id")), "left")
    hit = hit.withColumn(text_col, F.when(F.col("__values").isNull(), text).otherwise(clean)).select(*docs.columns)
    return docs.filter(~may).unionByName(hit)
