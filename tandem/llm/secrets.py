"""Secret scans: candidates by pattern, false positives removed by a random forest.

DataFrame expressions and Spark ML only.  A candidate's features are its length, its
changes of character class, how much of it dictionary words cover, whether it looks
like part of a path, and the words beside it.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, whole

# Runs of 16 or more key characters with a digit among them, what is
# assigned to a name that holds a word for secrets (the value alone is the candidate, the
# name its context), passwords in urls, and blocks of private keys through their END line,
# or without one through their lines of key characters.  Each run is tried once, from its
# start, and read to its end however long it is.
_KEY = "A-Za-z0-9+/_=.~-"
_LEAD = rf"(?:(?<![{_KEY}])[{_KEY}]*?)?"
_WORD = (r"(?i:passw(?:or)?[dt]|passwd|pwd|kennwort|contrase(?:ñ|n)a|mot_?de_?passe|secret|api[_-]?key|access[_-]?key|private[_-]?key"
         r"|credential|token)[A-Za-z0-9_.-]*+")
_SET = r"[\"']?\s{0,3}[:=]\s{0,3}[\"']?"
_BLOCK = r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
RUN = rf"(?<![{_KEY}])(?=[A-Za-z+/_=.~-]*+[0-9])[{_KEY}]{{16,}}+"
PEM = (rf"{_BLOCK}(?:[^-]*+(?:-(?!----)[^-]*+)*+-----END [A-Z ]{{0,20}}PRIVATE KEY-----"
       r"|(?:(?:\s|\\[nr])++[A-Za-z0-9+/=]{16,}+)*+)")
_LOGIN = r"://[^\s/:@\"'<>]*+:"
LOGIN = rf"{_LOGIN}[^\s/@\"'<>]{{3,}}+(?=@)"
ASSIGNED = rf"{_LEAD}(?:{_WORD}{_SET}(?:{PEM}|(?!{_BLOCK})[^\s\"']{{6,}}+)|{PEM})"
NAME = rf"^(?:{_LOGIN}|[{_KEY}]*?(?:{_WORD}{_SET}(?=[^\s\"']{{6}})|(?={_BLOCK})))"
HINTS = ("passw", "pwd", "kennwort", "contrase", "passe", "secret", "token", "api", "access", "private", "credential", "://")
MARK = "\ue000"  # stands round candidates; a text's own such characters count as spaces
DICTIONARY = ("password", "example", "license", "version", "message", "default", "release", "article", "product", "content",
              "index", "image", "users", "admin", "token", "title", "there", "which", "about", "other", "their", "would",
              "this", "that", "with", "from", "have", "file", "path", "data", "test", "main", "page", "html", "http", "name",
              "ation", "heit", "lich", "keit", "ment", "eau", "mente", "tion", "the", "and", "for", "are", "ing", "com", "www", "org")
SPEAKS_FOR = r"(?i)(token|secret|passw|api.?key|credential|auth|bearer|private|access.?key|pwd)"
SPEAKS_AGAINST = r"(?i)(commit|sha\d*|md5|digest|checksum|hash|uuid|guid|revision|etag|example|order|invoice|isbn|card|http|href|src)"


def with_candidates(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with an array ``name`` of (pos, candidate, before, after, skipped), null
    for none; ``skipped`` characters stand between a candidate and the one before.

    The pattern runs once for a text: its parts come out of a generator of one row, which
    Spark does not copy into the expressions that use them several times."""
    low, col = F.lower(F.col(text)), F.col(text)
    hint = col.rlike("[0-9]") | reduce(or_, [low.contains(x) for x in HINTS])
    marked = F.regexp_replace(F.translate(col, MARK, " "), f"({ASSIGNED}|{LOGIN}|{RUN})", f"{MARK}$1{MARK}")
    parts = F.col(f"{name}_parts")
    found = F.transform(
        F.sequence(F.lit(1), F.size(parts) - 1, F.lit(2)),
        lambda i: F.struct(i.alias("pos"), F.get(parts, i).alias("candidate"),
                           F.substring(F.get(parts, i - 1), -40, 40).alias("before"),
                           F.substring(F.get(parts, i + 1), 1, 24).alias("after"), F.length(F.get(parts, i - 1)).alias("skipped")))
    return (rows.select("*", F.explode(F.array(F.when(hint, F.split(marked, MARK)))).alias(f"{name}_parts"))
            .withColumn(name, F.when(F.size(parts) > 1, found)).drop(f"{name}_parts"))


def candidates(rows: DataFrame) -> DataFrame:
    """doc_id, row, start, end (code points), candidate, before, after, from ``rows``
    (doc_id, row, c): ``row`` is a key of each row, c its array of `with_candidates`."""
    rows = rows.select("doc_id", "row", F.explode("c").alias("c")).select("doc_id", "row", "c.*")
    # short rows only from here on; a window holds one document's candidates
    upto = F.sum(F.col("skipped") + F.length("candidate")).over(
        Window.partitionBy("row").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("end", upto.cast("long"))
    value = F.regexp_replace("candidate", NAME, "")
    prefix = F.substring(F.col("candidate"), F.lit(1), F.length("candidate") - F.length(value))
    return rows.select("doc_id", "row", (F.col("end") - F.length(value)).alias("start"), "end", value.alias("candidate"),
                       F.concat("before", prefix).alias("before"), "after")


def features(c: Column, before: Column, after: Column) -> dict[str, Column]:
    size = F.greatest(F.length(c), F.lit(1))
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) / size
    flag = lambda col, pattern: col.rlike(pattern).cast("double")
    words = "|".join(sorted(DICTIONARY, key=len, reverse=True))
    return {
        "length": F.length(c).cast("double"), "digits": share("[0-9]"), "uppers": share("[A-Z]"), "vowels": share("[aeiouAEIOU]"),
        "letter_digit": share("[A-Za-z](?=[0-9])"), "digit_letter": share("[0-9](?=[A-Za-z])"), "case": share("[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        "signs": share("[+/_=.~-]"), "distinct": F.size(F.array_distinct(F.split(c, ""))) / size,
        "dictionary": 1 - F.length(F.regexp_replace(F.lower(c), words, "")) / size,
        "hex": flag(c, "^([0-9a-f]+|[0-9A-F]+)$"), "number": flag(c, "^[0-9.+_-]+$"),
        "uuid": flag(c, "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"),
        "known": flag(c, "^(AKIA|ASIA|gh[pousr]_|xox[abprs]-|sk-|eyJ|-----BEGIN)"),
        "placeholder": flag(c, r"^(\$[{(A-Z_]|<|%[({A-Z]|\{\{|\*{3})"), "path": flag(c, r"^\.{0,2}/|/[^/]*/|\.[a-z]{2,4}$|^www\."), "in_url": flag(before, r"(://|@|[/?&=#.])$"),
        "assigned": flag(before, r"[:=]\s{0,3}[\"']?$"), "quoted": (flag(before, "[\"']$") + flag(after, "^[\"']")) / 2,
        "for": flag(before, SPEAKS_FOR + r"(\W{0,6}(is|was|ist|=|:)?\W{0,4}|[A-Za-z0-9_.-]{0,40}[\"']?\s{0,3}[:=]\s{0,3}[\"']?)$"), "against": flag(before, SPEAKS_AGAINST + r"[^.;]{0,16}$"),
        "login": flag(before, r"://[^\s/:@]*:$") * flag(after, "^@"), "hashed": flag(c, r"^(?i:sha-?(1|256|384|512)|md5)[-:=]"),
        "points": flag(before, r"(?i)(name|header|file|path|url|uri|field|type|id|endpoint|expiry|ttl|hash|count|length|limit)[\"']?\s{0,3}[:=]\s{0,3}[\"']?$"),
        "plain": flag(c, "^[A-Za-z][a-z]*([ _-][A-Za-z][a-z]*)*[.,;:!?]?$"),
    }


def labelled_findings(spark: SparkSession, n: int = 1200) -> DataFrame:
    """A small labelled table (before, candidate, after, label), made by rule from hashes."""
    i = F.col("id")
    h = F.sha1(F.concat(F.lit("finding"), i.cast("string")))
    b64 = F.translate(F.base64(F.unhex(h)), "=", "")
    digits = F.substring(F.regexp_replace(F.concat(h, F.sha1(h)), "[a-f]", ""), 1, 16)
    upper = F.substring(F.upper(F.translate(b64, "+/", "QZ")), 1, 16)
    word = F.element_at(F.array(*map(F.lit, ("report", "ration", "lichkeit", "mentelle", "theresh", "ciónque"))), (i % 6 + 1).cast("int"))
    uuid = F.concat_ws("-", *[F.substring(h, a, n_) for a, n_ in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    yes = (
        ("the token = \"", h, "\" and"), ("API_KEY='", b64, "'\nnext"), ("aws key ", F.concat(F.lit("AKIA"), upper), " here"),
        ("secret: ", b64, "\n"), ("Authorization: Bearer ", F.concat(F.lit("ghp_"), b64, F.substring(h, 1, 9)), "\n"),
        ("TOKEN = \"", F.upper(h), "\"!! THE"), ("password=", F.substring(b64, 1, 14), " "), ("", F.lit("-----BEGIN RSA PRIVATE KEY-----"), "\nMII"),
        ("DB_PASSWORD=", F.substring(b64, 1, 13), "\n"), ("export AWS_SECRET_ACCESS_KEY=", F.concat(b64, F.substring(h, 1, 12)), "\n"),
        ("&client_secret=", F.substring(h, 1, 32), "\n"), ("AWS_ACCESS_KEY_ID=", F.concat(F.lit("AKIA"), upper), "\n"),
        ("key: ", F.concat(F.lit("-----BEGIN PRIVATE KEY-----\n"), b64, b64, F.lit("\n"), b64, F.lit("\n-----END PRIVATE KEY-----")), "\n"),
        ("db = postgres://app:", F.substring(b64, 2, 11), "@db1.example.com/main"), ("https://bob:", F.substring(h, 3, 12), "@git.example.org/x"),
        ("amqp://svc:", F.concat(F.initcap(word), F.substring(digits, 1, 3), F.lit("!")), "@queue"),
        ("kennwort: ", F.concat(F.initcap(word), F.substring(digits, 1, 2), F.lit("x"), F.substring(upper, 1, 2)), "\n"),
        ("passwort=", F.concat(F.initcap(word), F.substring(digits, 1, 4), F.lit("!")), "\n"),
    )
    no = (
        ("see commit ", h, " of"), ("sha1: ", h, "\n"), ("id ", uuid, " in"), ("https://www.example.com", F.concat(F.lit("/en/"), word, F.lit("/"), digits, F.lit(".html")), " the"),
        ("number ", digits, ", this"), ("path ", F.concat(F.lit("/usr/share/"), word, F.lit("/version-"), F.substring(digits, 1, 2), F.lit(".txt")), " and"),
        ("and the ", F.concat(word, F.lit("-"), word, F.lit("-"), F.substring(digits, 1, 4)), ". It"), ("mail ", F.concat(word, F.lit(".12@mail4.example.com")), " to"),
        ("md5 checksum ", F.md5(h), "\n"), ("the token = \"", F.concat(F.lit("example"), word, F.lit("123")), "\" and"),
        ("DB_PASSWORD=", F.concat(F.lit("${"), F.upper(word), F.lit("_PASSWORD}")), "\n"), ("", F.concat(F.lit("BUILD_ID="), digits), "\n"),
        ("&", F.concat(F.lit("page_title="), word, F.lit("-"), F.substring(digits, 1, 5)), "\n"), ("secret_name: ", F.concat(F.lit("example-"), word), "\n"),
        ("integrity ", F.concat(F.lit("sha512-"), b64, b64, F.lit("==")), "\n"), ("integrity=\"", F.concat(F.lit("sha384-"), b64, F.substring(b64, 1, 9)), "\" cross"),
        ("digest: ", F.concat(F.lit("sha256:"), h, F.substring(h, 1, 24)), "\n"), ("api_key_header: ", F.concat(F.lit("X-"), F.initcap(word), F.lit("-Key")), "\n"),
        ("token_type: ", F.concat(F.lit("Bearer-"), word), "\n"), ("password_file=", F.concat(F.lit("/run/secrets/"), word), "\n"),
        ("http://user:", F.lit("password"), "@host"), ("ftp://", F.concat(F.lit("${"), F.upper(word), F.lit("}")), "@host"), ("secret: ", F.concat(word, F.lit("-"), word), "\n"),
        ("access_token_url=", F.concat(F.lit("https://auth.example.com/"), word), "\n"), ("max_tokens: ", F.substring(digits, 1, 6), "\n"),
    )
    pick = lambda rows, k: F.element_at(F.array(*[F.struct(
        F.lit(a).alias("before"), c.alias("candidate"), F.lit(b).alias("after")) for a, c, b in rows]), (k % len(rows) + 1).cast("int"))
    half = F.floor(i / 2)
    row = F.when(i % 2 == 1, pick(yes, half)).otherwise(pick(no, half))
    return spark.range(0, n, 1, 1).select(row.alias("r"), (i % 2).cast("double").alias("label")).select("r.*", "label")


NAMES = (
    "length", "digits", "uppers", "vowels", "letter_digit", "digit_letter", "case", "signs", "distinct", "dictionary", "hex",
    "number", "uuid", "known", "placeholder", "path", "in_url", "assigned", "quoted", "for", "against", "login", "hashed", "points", "plain")


def vectors(rows: DataFrame) -> DataFrame:
    made = features(F.col("candidate"), F.col("before"), F.col("after"))
    rows = rows.withColumns({f"__{n}": made[n] for n in NAMES})
    return VectorAssembler(inputCols=[f"__{n}" for n in NAMES], outputCol="__x").transform(rows).drop(*[f"__{n}" for n in NAMES])


def fit(labelled: DataFrame) -> RandomForestClassificationModel:
    return RandomForestClassifier(featuresCol="__x", labelCol="label", numTrees=30, maxDepth=6, seed=7).fit(vectors(labelled))


def _judged(rows: DataFrame, labelled: DataFrame | None, threshold: float) -> DataFrame:
    """doc_id, row, start, end, candidate, score, is_secret of each candidate of ``rows``
    (see `candidates`)."""
    model = fit(labelled if labelled is not None else labelled_findings(rows.sparkSession))
    found = vectors(candidates(rows))
    score = vector_to_array("__p")[1]
    return model.setProbabilityCol("__p").transform(found).select(
        "doc_id", "row", "start", "end", "candidate", score.alias("score"), (score >= threshold).alias("is_secret"))


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """A row for each candidate: doc_id, start, end, candidate, score, is_secret.

    Null and empty texts have none; repeated rows (and null ids) are scanned each on its
    own; texts and secrets of any length are read whole; a score of exactly ``threshold``
    is a secret.  An empty table gives no rows; other columns are not read."""
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    return _judged(with_candidates(rows, "text", "c").select("doc_id", "row", "c"), labelled, threshold).drop("row")


def op3(docs: DataFrame) -> DataFrame:
    return scan(docs)


def redact(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5, to: str = "[SECRET]") -> DataFrame:
    """``docs`` with the span of each confirmed secret replaced in the text and n_chars,
    where there is such a column, brought up to date.  Each row has its own findings,
    whatever its doc_id; they are as many as its text has room for.

    Null and empty texts stay as they are, and so do all other columns, whatever their
    names; repeated rows are redacted each; an empty table stays empty."""
    # stored once with its candidates: the keys must not change between the two reads,
    # and the second one then reads no text
    packed = docs.select(whole(docs).alias("doc"), F.col("text").alias("text"), F.monotonically_increasing_id().alias("row"))
    kept = stored(with_candidates(packed, "text", "c").drop("text"), "redact")
    found = _judged(kept.select(F.lit(None).cast("long").alias("doc_id"), "row", "c"), labelled, threshold).where("is_secret")
    spans = (found.groupBy(F.col("row").alias("of"))
             .agg(F.array_sort(F.collect_list(F.struct(F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end")))).alias("spans")))
    joined = kept.select("doc", "row").join(spans, F.col("row") == F.col("of"), "left")
    text, at, found_any = F.col("doc.text"), F.col("spans"), F.col("spans").isNotNull()
    upto = lambda i: F.coalesce(F.get(at, i - 1)["end"], F.lit(0))
    parts = F.transform(at, lambda x, i: F.concat(F.substring(text, upto(i) + 1, x["start"] - upto(i)), F.lit(to)))
    new = F.when(found_any, F.concat(F.array_join(parts, ""), F.substring(text, upto(F.size(at)) + 1, F.length(text)))).otherwise(text)
    out = joined.select("doc", new.alias("new"), found_any.alias("changed"))
    size = F.when(F.col("changed"), F.length("new"))
    column = {"text": F.col("new"), "n_chars": F.coalesce(size, F.col("doc.n_chars")).cast(docs.schema["n_chars"].dataType)} \
        if "n_chars" in docs.columns else {"text": F.col("new")}
    return out.select(*[column.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
