"""Secret scan: runs that look like keys are proposed, a random forest removes the false ones.

Candidates are all long runs of key characters inside words, and shorter ones that a secret's name is given. The forest learns from labelled findings and sees length, shares
and changes of character classes, distinct characters, how much of the run is made of the corpus' common letter triples
(dictionary coverage), path signs, and the neighbouring words. All of it is DataFrame work.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqloom.operators.staging import stage

MIN_RUN = 16
RUN = r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_RUN
# A run with what stands before it since the run before; the parts of a word follow each other without gaps.
PART = r"[^A-Za-z0-9+/_-]*[A-Za-z0-9+/_-]+={0,2}"
GAP = r"^[^A-Za-z0-9+/_-]*"
MAX_FINDINGS = 20_000
#: Words counted as the dictionary; their letter triples (at most 26^3) go to every task.
DICTIONARY = 20_000
TREES, TREE_DEPTH = 40, 6
THRESHOLD = 0.5

# Names that announce a secret, and the shape of one public key format.
NAMES = r"(?i)(password|passwd|secret|token|api_?key|access_?key|private_?key)"
KEY_ID = r"^AKIA[0-9A-Z]{16}$"
# The end of a text that gives its next run to a name.
GIVEN = NAMES + r"[\"']?\x20*[=:]+\x20*[\"']?$"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, `row`, `position` (word number from 0), `offset` (of the run in the word, from 0), `word`, `run`, `before` (two
    words), `after` (one word), `given`: the run stands right behind a secret's name and a sign."""
    words = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), words_of(F.col("text")).alias("words"))
    word = lambda at: F.coalesce(F.try_element_at("words", (at + 1).cast("int")), F.lit(""))
    earlier = lambda at, i: F.when(at >= i, word(at - i)).otherwise("")
    before = lambda at: F.concat_ws(" ", earlier(at, 2), earlier(at, 1))
    # a short run can only be a candidate in a word that has a name, or right behind one
    seen = lambda w, i: (F.length(w) >= MIN_RUN) | w.rlike(NAMES) | before(i).rlike(NAMES)
    spots = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("position"), seen(w, i).alias("seen"))), lambda spot: spot["seen"])
    each = words.select("doc_id", "row", "words", F.explode(spots).alias("spot"))
    at = F.col("spot.position")
    each = each.select("doc_id", "row", at.alias("position"), word(at).alias("word"), before(at).alias("before"), word(at + 1).alias("after"))
    each = each.withColumn("parts", F.regexp_extract_all("word", F.lit(PART), F.lit(0)))

    def hit(part: Column, i: Column) -> Column:
        previous = F.when(i > 0, F.try_element_at("parts", F.greatest(i, F.lit(1)).cast("int"))).otherwise(F.concat("before", F.lit(" ")))
        given = F.concat(F.substring(previous, -64, 64), F.regexp_extract(part, GAP, 0)).rlike(GIVEN)
        return F.struct(i.alias("i"), F.regexp_replace(part, GAP, "").alias("run"), given.alias("given"))

    hits = F.filter(F.transform("parts", hit), lambda h: h["run"].rlike(f"^{RUN}$") | h["given"])
    found = each.withColumn("hit", F.explode(hits))
    until = F.length(F.array_join(F.slice("parts", F.lit(1), F.col("hit.i") + 1), ""))
    return found.select(
        "doc_id", "row", "position", (until - F.length("hit.run")).alias("offset"), "word", F.col("hit.run").alias("run"), "before", "after",
        F.col("hit.given").alias("given"),
    )


def labelled(found: DataFrame) -> DataFrame:
    """The candidates with `label`: 1 a key format or a run given to a secret's name, 0 letters or digits alone, else null."""
    name = F.regexp_extract("word", r"^(.*?)" + RUN, 1)
    first = F.concat_ws(" ", "before", name).rlike(NAMES) & F.concat("before", F.lit(" "), name).rlike(r"[=:]")
    given = F.col("given") | (first & (F.col("offset") == F.length(name)) & F.col("run").rlike(f"^{RUN}$"))
    both = F.col("run").rlike("[0-9]") & F.col("run").rlike("[A-Za-z]")
    plain = ~F.col("run").rlike("[0-9]") | ~F.col("run").rlike("[A-Za-z]")
    label = F.when(F.col("run").rlike(KEY_ID) | (given & both), 1.0).when(plain & F.col("run").rlike(f"^{RUN}$"), 0.0)
    return found.withColumn("label", label)


def triples(text: Column) -> Column:
    """The distinct lower-case letter triples of a text."""
    low = F.lower(text)
    cut = F.transform(F.sequence(F.lit(1), F.greatest(F.length(low) - 2, F.lit(1))), lambda i: F.substring(low, i, F.lit(3)))
    return F.array_distinct(F.filter(cut, lambda t: t.rlike("^[a-z]{3}$")))


def dictionary(docs: DataFrame, most: int = DICTIONARY) -> DataFrame:
    """`triple`, the letter triples of the `most` commonest words of all documents: 17,576 rows at most."""
    words = docs.select(F.explode(words_of(F.lower("text"))).alias("word")).where(F.length("word").between(3, 32))
    common = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "word").limit(most)
    return common.select(F.explode(triples(F.col("word"))).alias("triple")).distinct()


def described(found: DataFrame, known: DataFrame) -> DataFrame:
    """The candidates with `x`, their features."""
    run = F.col("run")
    size = F.length(run)
    share = lambda pattern: F.regexp_count(run, F.lit(pattern)) / size
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(run, "[A-Z]", "A"), "[a-z]", "a"), "[0-9]", "9")
    changes = F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1
    keyed = found.withColumn("key", F.struct("row", "position", "offset"))
    cut = keyed.select("key", F.explode(triples(run)).alias("triple"))
    met = cut.join(F.broadcast(known.withColumn("hit", F.lit(1))), "triple", "left").groupBy("key").agg(F.count("hit").alias("hits"), F.count(F.lit(1)).alias("all"))
    joined = keyed.join(met.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key"), "left").drop("_key", "key")
    flag = lambda condition: F.coalesce(condition.cast("double"), F.lit(0.0))
    x = F.array(
        size.cast("double"), share("[0-9]"), share("[A-Z]"), share("[a-z]"), share("[+/_=-]"), share("[g-zG-Z]"),
        changes / size, (F.size(F.array_distinct(F.split(run, ""))) / size).cast("double"),
        F.coalesce(F.col("hits") / F.col("all"), F.lit(0.0)), F.coalesce(F.col("all").cast("double"), F.lit(0.0)),
        flag(F.col("word").rlike(r"^(\.{0,2}/|[A-Za-z]:\\)|://")), flag(F.col("word").contains("/")), flag(F.col("word").contains("=")), flag(F.col("word").rlike("[\"']")),
        flag(F.col("before").rlike(NAMES)), flag(F.col("before").rlike(r"[=:]$")), flag(F.col("word").rlike(NAMES)), flag(F.col("after").rlike(r"^[A-Za-z,.]+$")),
    )
    return joined.withColumn("x", F.transform(x, lambda value: value.cast("double"))).drop("hits", "all")


def train(findings: DataFrame, most: int = MAX_FINDINGS) -> RandomForestClassificationModel | None:
    """The forest, learnt from at most about `most` findings (`x`, `label` 0 or 1) of each label; None without both labels."""
    known = findings.where("label is not null")
    counts = {row.label: row.n for row in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None
    share = F.when(F.col("label") == 1.0, F.lit(most / counts[1.0])).otherwise(F.lit(most / counts[0.0]))
    drawn = known.where(F.pmod(F.xxhash64("row", "position"), F.lit(1_000_000)) < share * 1_000_000)
    learn = stage(drawn.select(array_to_vector("x").alias("features"), "label").coalesce(4))
    return RandomForestClassifier(numTrees=TREES, maxDepth=TREE_DEPTH, featureSubsetStrategy="onethird", seed=1).fit(learn)


def scan(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """doc_id, `position`, `offset`, `word`, `run`, `score`, `is_secret` of every candidate in every whole text.

    `docs` has doc_id and text; other columns play no part. `findings` are labelled candidates with their features; without
    them, `labelled` marks the corpus' own. Null and empty texts have no candidates. Rows that repeat are scanned each.
    Without findings of both labels all candidates score 1: nothing is removed. An empty table gives an empty one.
    """
    found = stage(described(stage(candidates(docs)), dictionary(docs)))
    model = train(labelled(found) if findings is None else findings)
    if model is None:
        scored = found.withColumn("score", F.lit(1.0))
    else:
        scored = model.transform(found.withColumn("features", array_to_vector("x"))).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "position", "offset", "word", "run", "score", (F.col("score") >= THRESHOLD).alias("is_secret"))
