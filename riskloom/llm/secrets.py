"""Secret scans: pattern candidates, and a random forest that removes false positives.

Candidates are long runs of key characters, dotted tokens, values assigned to a word that
names secrets, credentials in addresses, and blocks of private keys. Each is described by its length and the way its characters change, by how much of it the words of
the corpus explain, by whether it lies in a path, and by the words around it. A random
forest trained on labelled findings decides which of them are secrets. Nothing but DataFrame
operations and Spark ML.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import hashed_sample, most_frequent, table
from riskloom.session import durable

# Words that stand before secrets, and before long strings that are none.
SECRET_WORDS = ["api", "auth", "bearer", "credential", "key", "passwd", "password", "private", "pwd", "secret", "token"]
PUBLIC_WORDS = ["checksum", "commit", "digest", "etag", "hash", "id", "md5", "revision", "sha1", "sha256", "uuid", "version"]
PLACEHOLDERS = ["change", "dummy", "example", "placeholder", "sample", "xxxx", "your"]

#: What stands before the value of a candidate and is not part of it: the scheme and user of an
#: address, or an assignment to a word that names secrets.
_ADDRESS = r"(?<![a-z0-9+.-])[a-z][a-z0-9+.-]{1,15}://[^\s:/@\"']{1,64}:"
_ASSIGNED = (r"(?i:(?<![a-z])(?:[a-z0-9]{1,24}[_-]){0,4}(?:" + "|".join(SECRET_WORDS)
             + r")s?[\"']?\s?(?:=>|[=:])\s?[\"']?)")
#: Marks that end a clause belong to a value only inside it.
_VALUE = r"(?:[^\s\"',;.)\]}]|[,;.)\]}](?=[^\s\"',;.)\]}])){6,}+"
_BLOCK = r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}+(?:-----END [A-Z ]{0,20}PRIVATE KEY-----)?"
_DOTTED = r"(?<![A-Za-z0-9+/_.-])[A-Za-z0-9_-]{8,}+(?:\.[A-Za-z0-9_-]{6,}+){2}"
_RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}"
#: A candidate, with what stands before it where that makes it one.
CANDIDATE = rf"{_BLOCK}|{_ADDRESS}[^\s\"'@/]{{4,}}+(?=@)|{_ASSIGNED}{_VALUE}|{_DOTTED}|{_RUN}"

#: Most frequent words of the corpus that explain parts of a candidate.
DICTIONARY_WORDS = 4096
#: Documents whose words surround the labelled findings the forest is trained on.
TRAIN_DOCUMENTS = 1500
#: Probability from which a candidate counts as a secret.
SECRET_SCORE = 0.5
LEFT, RIGHT = 48, 16
#: Candidates of a text whose lengths are summed at a time.
_SUMMED = 256

FEATURES = [
    "length", "digits", "upper", "other", "distinct", "changes", "dictionary", "in_path", "slashes",
    "file_end", "secret_word", "public_word", "assigned", "quoted", "placeholder",
]


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, number, start, value, left, right`` of each candidate of ``docs(doc_id,
    text)``. ``number`` counts the candidates of a text from 0, ``start`` characters."""
    found = docs.where(F.col("text").rlike(CANDIDATE)).select(
        "doc_id", F.xxhash64("text").alias("text_hash"),
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("hits"),
        F.split("text", CANDIDATE, -1).alias("between"))
    # Lengths up to each candidate, and sums of whole blocks of them: no sum runs over all.
    lengths = F.zip_with("between", "hits", lambda b, h: F.length(b) + F.coalesce(F.length(h), F.lit(0)))
    add = lambda numbers: F.aggregate(numbers, F.lit(0), lambda n, x: n + x)
    found = found.withColumn("lengths", lengths)
    last = F.floor((F.size("hits") - 1) / _SUMMED).cast("int")
    found = found.withColumn("sums", F.transform(
        F.sequence(F.lit(0), last), lambda b: add(F.slice("lengths", b * _SUMMED + 1, F.lit(_SUMMED)))))
    found = found.withColumn("before", F.transform(
        F.sequence(F.lit(0), last), lambda b: add(F.slice("sums", F.lit(1), b))))
    rows = found.select("doc_id", "text_hash", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("hits") - 1),
        lambda i: F.struct(
            i.alias("number"), F.get("hits", i).alias("hit"),
            (F.get("before", F.floor(i / _SUMMED).cast("int")) + F.length(F.get("between", i))
             + add(F.slice("lengths", F.floor(i / _SUMMED).cast("int") * _SUMMED + 1, i % _SUMMED))).alias("start"),
            F.right(F.get("between", i), F.lit(LEFT)).alias("left"),
            F.left(F.get("between", i + 1), F.lit(RIGHT)).alias("right")))).alias("c")).select("doc_id", "text_hash", "c.*")
    value = F.regexp_replace("hit", f"^(?:{_ADDRESS}|{_ASSIGNED})", "")
    named = F.left("hit", F.length("hit") - F.length(value))
    return rows.select(
        "doc_id", "text_hash", "number", (F.col("start") + F.length(named)).alias("start"), value.alias("value"),
        F.concat("left", named).alias("left"), "right")


def frequent_words(docs: DataFrame, size: int = DICTIONARY_WORDS) -> list[str]:
    """The most frequent words of at least three letters over all texts."""
    words = docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")).where(F.length("word") >= 3)
    return most_frequent(words.groupBy("word").agg(F.count("*").alias("n")).where("n > 1"), size)


def _any_word(text: Column, words: list[str]) -> Column:
    return text.rlike(r"(?i)(?<![a-z])(?:[a-z]+[_-])*(?:" + "|".join(words) + r")s?(?![a-z])").cast("double")


def described(findings: DataFrame, dictionary: list[str]) -> DataFrame:
    """Add the features of a finding with ``value``, ``left`` and ``right``; none is ever null."""
    value, left = F.coalesce("value", F.lit("")), F.coalesce("left", F.lit(""))
    right = F.coalesce("right", F.lit(""))
    size = F.greatest(F.length(value), F.lit(1))
    share = lambda pattern: (F.length(F.regexp_replace(value, pattern, "")) / size)
    # One letter for each kind of character; a run of one kind counts once.
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        value, "[a-z]", "a"), "[A-Z]", "B"), "[0-9]", "0"), "[^aB0]", "-")
    runs = F.length(F.regexp_replace(kinds, r"(.)\1+", "$1"))
    known = F.split(F.lit(" ".join(dictionary)), " ")
    parts = F.split(F.lower(F.regexp_replace(value, "(?<=[a-z])(?=[A-Z])", "_")), r"[^\p{L}]+")
    explained = F.aggregate(F.filter(parts, lambda p: F.array_contains(known, p)), F.lit(0), lambda n, p: n + F.length(p))
    return findings.select(
        "*",
        F.length(value).cast("double").alias("length"), share("[^0-9]").alias("digits"), share("[^A-Z]").alias("upper"),
        share("[A-Za-z0-9]").alias("other"),
        (F.size(F.array_distinct(F.split(value, ""))) / size).alias("distinct"), (runs / size).alias("changes"),
        (explained / size).alias("dictionary"),
        left.rlike(r"(?:[a-z]{2,}://|[/\\.])\S*$").cast("double").alias("in_path"),
        (F.length(value) - F.length(F.replace(value, F.lit("/"), F.lit("")))).cast("double").alias("slashes"),
        right.rlike(r"^\.[a-z]{2,4}\b").cast("double").alias("file_end"),
        _any_word(left, SECRET_WORDS).alias("secret_word"), _any_word(left, PUBLIC_WORDS).alias("public_word"),
        left.rlike(r"[=:]>?\s?[\"']?$").cast("double").alias("assigned"),
        (left.rlike("[\"']$") & right.rlike("^[\"']")).cast("double").alias("quoted"),
        value.rlike("(?i)" + "|".join(PLACEHOLDERS) + r"|(.)\1{5}").cast("double").alias("placeholder"),
    )


def labelled_findings(docs: DataFrame, documents: int = TRAIN_DOCUMENTS) -> DataFrame:
    """Findings ``value, left, right, label`` for training, made from a bounded number of texts.

    Their words stand around keys of common shapes, drawn from hashes of the text (label 1),
    and around what is taken for a key by mistake (label 0): joined words, paths, commit and
    file hashes, running numbers, identifiers, placeholders and file names.
    """
    # A text's end is as good as any other place of it.
    some = docs.where(F.length("text") > 0).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h"))
    base = hashed_sample(some, ["h"], documents).select("h", F.right("text", F.lit(600)).alias("t"))
    base = base.orderBy("h", "t").limit(documents).select(
        "h", F.split(F.lower("t"), r"[^\p{L}]+").alias("w"), F.sha1("t").alias("hex"), F.sha2(F.col("t"), 256).alias("hex2"))
    word = lambda k: F.coalesce(F.get("w", F.pmod(F.xxhash64("h", F.lit(k)), F.size("w")).cast("int")), F.lit("a"))
    pick = lambda k, values: F.get(F.array(*map(F.lit, values)), F.pmod(F.xxhash64("h", F.lit(k)), F.lit(len(values))).cast("int"))
    b64 = F.translate(F.base64(F.unhex("hex2")), "=", "")
    sign = pick(1, [" = ", "=", ": ", ":"])
    quote = pick(2, ['"', "'", ""])
    said = F.concat(word(3), F.lit(" "), word(4), F.lit(" "))
    named = F.concat(said, pick(5, ["token", "TOKEN", "api_key", "secret", "auth_token", "private_key", "password"]), sign, quote)
    public = F.concat(said, pick(6, ["commit ", "sha1: ", "checksum ", "etag: ", "revision ", "md5="]))
    plain = F.concat(said, word(7), F.lit(" "))
    host = F.concat(said, F.lit("https://"), word(8), F.lit(".com/"), word(9), F.lit("/"))
    login = F.concat(said, pick(36, ["postgres", "mysql", "https", "amqp", "redis"]), F.lit("://"), word(37), F.lit(":"))
    n = F.pmod(F.xxhash64("h", F.lit(10)), F.lit(12)).cast("int")
    none, space = F.lit(""), F.concat(F.lit(" "), word(11))
    rows = [
        (1, F.col("hex"), named, quote), (1, F.upper("hex"), named, quote), (1, F.left("hex2", F.lit(32)), named, quote),
        (1, F.left(b64, F.lit(20) + n), named, quote), (1, b64, F.concat(said, F.lit("bearer ")), space),
        (1, F.concat(F.lit("AKIA"), F.upper(F.left("hex2", F.lit(16)))), plain, space),
        (1, F.concat(F.lit("ghp_"), F.translate(F.left(b64, F.lit(36)), "+/", "ab")), plain, space),
        # Short secrets, of letters and digits or with other marks; credentials, dotted tokens, key blocks.
        (1, F.concat(F.left(b64, F.lit(5)), pick(21, list("#$!~.%&*")), F.substr("hex", F.lit(3), F.lit(3) + n % 4)), named, quote),
        (1, F.translate(F.left(b64, F.lit(8) + n % 6), "+/", "x7"), named, quote),
        (1, F.concat(F.initcap(word(22)), F.substr("hex2", F.lit(9), F.lit(4)), pick(23, list("!?#") + [""])), named, quote),
        (1, F.concat(F.left(b64, F.lit(6)), pick(24, list("#$!~.")), F.left("hex", F.lit(3))), login, F.concat(F.lit("@"), word(9))),
        (1, F.concat(word(25), F.left("hex", F.lit(3))), login, F.concat(F.lit("@"), word(9))),
        (1, F.concat_ws(".", F.translate(F.left(b64, F.lit(20)), "+/", "-_"), F.left("hex", F.lit(24)), F.translate(F.right(b64, F.lit(22)), "+/", "-_")),
         F.concat(said, pick(26, ["bearer ", "token=", ""])), space),
        (1, F.concat(F.lit("-----BEGIN PRIVATE KEY-----\n"), b64, F.lit("\n"), F.base64(F.encode("hex", "UTF-8"))), plain, none),
        (0, word(27), named, quote), (0, F.concat_ws("-", word(27), word(28)), named, quote),
        (0, F.concat(word(27), pick(29, [".", ",", ";", "()", ".md"])), named, quote),
        (0, F.concat_ws(".", word(12), word(13), word(14)), named, none), (0, F.concat_ws(".", word(30), word(31), word(32)), plain, space),
        (0, F.concat(F.lit("<"), word(33), F.lit(">")), named, quote), (0, F.concat(F.lit("${"), F.upper(word(34)), F.lit("}")), named, quote),
        (0, pick(35, ["required", "undefined", "optional", "string", "boolean", "disabled", "hidden;", "primary", "********"]), named, quote),
        (0, F.col("hex"), public, space), (0, F.left("hex2", F.lit(32)), public, space), (0, F.upper("hex"), public, space),
        (0, F.concat_ws("_", word(12), word(13), word(14), word(15)), plain, space),
        (0, F.concat_ws("_", word(12), word(13), word(14), word(15)), named, quote),
        (0, F.concat(word(16), word(17), word(18)), plain, space),
        (0, F.upper(F.concat(word(16), word(17), word(18))), F.upper(plain), space),
        (0, F.upper(F.concat_ws("_", word(16), word(17), word(18))), plain, space),
        (0, F.concat_ws("/", word(12), word(13), word(14), word(15)), F.concat(plain, F.lit("/")), F.lit(".txt")),
        (0, F.concat(word(12), F.initcap(word(13)), F.initcap(word(14))), host, space),
        (0, F.concat(F.left(b64, F.lit(22))), host, F.lit(".png")), (0, F.left("hex2", F.lit(24)), host, F.lit(".html")),
        (0, F.lpad(F.pmod(F.col("h"), F.lit(10 ** 16)).cast("string"), 16, "4"), plain, space),
        (0, F.regexp_replace("hex2", "^(.{8})(.{4})(.{4})(.{4})(.{12}).*$", "$1-$2-$3-$4-$5"),
         F.concat(said, pick(19, ["id=", "uuid ", "id: "])), space),
        (0, pick(20, ["xxxxxxxxxxxxxxxxxxxx", "your_api_key_goes_here", "example_token_0123456789", "changeme-changeme-changeme"]), named, quote),
        (0, F.lit("----------------------------------------"), plain, none),
    ]
    made = F.array(*[F.struct(F.lit(float(y)).alias("label"), v.alias("value"), left.alias("left"), r.alias("right"))
                     for y, v, left, r in rows])
    return base.select(F.explode(made).alias("f")).select("f.*")


def train(labelled: DataFrame, dictionary: list[str], trees: int = 30, depth: int = 8) -> RandomForestClassificationModel | None:
    """Fit the forest on findings with a ``label`` of 0 or 1; None unless both occur."""
    rows = durable(described(labelled.where("label in (0, 1)"), dictionary).select("label", *FEATURES))
    if rows.select("label").distinct().count() < 2:
        return None
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, seed=11)
    return forest.fit(data.select("label", "features"))


def judged(found: DataFrame, model: RandomForestClassificationModel | None, dictionary: list[str]) -> DataFrame:
    """Candidates with ``score``, the forest's probability, and ``secret``. Nothing is a secret
    where there is no forest, and so nothing to tell by."""
    if model is None:
        return found.withColumn("score", F.lit(0.0)).withColumn("secret", F.lit(False))
    keep = found.columns
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(described(found, dictionary))
    scored = model.transform(data.select(*keep, "features")).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select(*keep, "score").withColumn("secret", F.col("score") >= SECRET_SCORE)


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """All candidates of ``docs(doc_id, text)``: ``doc_id, text_hash, number, start, value, left,
    right, score, secret``.

    ``labelled`` holds findings with ``value, left, right, label``; without any, or with
    findings of one label only, they are made from the texts: any text that has a candidate gives findings
    of both labels, so a forest is there whenever there is something to judge. Null and empty
    texts have no candidates; texts of any length are scanned whole. Candidates do not overlap: the
    leftmost wins, at one place the first kind of the pattern. Rows that repeat an identifier
    are scanned each. An empty table gives an empty result; other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    dictionary = frequent_words(docs)
    model = None if labelled is None else train(labelled, dictionary)
    model = model or train(labelled_findings(docs), dictionary)
    return judged(durable(candidates(docs)), model, dictionary)


def op2_secret_scan(spark, sf_dir):
    """The findings that the forest keeps: where they are, and a digest instead of the secret."""
    found = scan(table(spark, sf_dir, "documents"))
    return found.where("secret").select(
        "doc_id", F.col("start").cast("long").alias("start"), F.length("value").cast("long").alias("length"),
        F.sha2("value", 256).alias("value_sha256"), "score")


MASK = "[SECRET]"


def stage(spark, docs, sf_dir):
    """Pipeline stage: all documents, with ``[SECRET]`` in place of every secret.

    ``text`` changes, and ``n_chars`` with it where a document has a secret; all else comes
    back as it was, whatever the columns' names. Null and empty texts stay as they are, rows that repeat are
    masked each, an empty table gives an empty result.
    """
    found = scan(docs)
    # A row per candidate of a text: repeated rows have the same ones.
    marks = found.groupBy(F.col("doc_id").alias("its_id"), F.col("text_hash").alias("its_hash")).agg(
        F.max("secret").alias("any"),
        F.array_sort(F.collect_set(F.struct("number", "secret", F.length("value").alias("size")))).alias("marks")
    ).where("any").drop("any")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    joined = rows.join(marks, F.col("id").eqNullSafe(F.col("its_id")) & (F.col("hash") == F.col("its_hash")), "left")
    text = F.col("row.text")
    parts = joined.where("marks is not null").select(
        "row", "marks", F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("hits"), F.split(text, CANDIDATE, -1).alias("between"))
    hit = lambda i: F.get("hits", i)
    shown = lambda i: F.when(F.get("marks", i)["secret"], F.concat(
        F.left(hit(i), F.length(hit(i)) - F.get("marks", i)["size"]), F.lit(MASK))).otherwise(F.coalesce(hit(i), F.lit("")))
    masked = parts.select("row", F.array_join(F.transform("between", lambda b, i: F.concat(b, shown(i))), "").alias("masked"))
    everyone = joined.where("marks is null").select("row", F.lit(None).cast("string").alias("masked")).unionByName(masked)
    new = {"text": F.coalesce("masked", text),
           "n_chars": F.when(F.col("masked").isNull(), F.col("row")["n_chars"] if "n_chars" in docs.columns else F.lit(0))
           .otherwise(F.length("masked").cast("long"))}
    return everyone.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])
