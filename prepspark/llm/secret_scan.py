"""Secret scan: a random forest removes false positives (DataFrame functions and Spark ML in the
JVM only).

1. Candidates are all places of a text with a run of ``MIN_LENGTH`` or more token characters with
   a digit or a change of letter case in it, or a known prefix, and runs of ``MIN_ASSIGNED`` or more
   characters of any kind that a key word and an assignment mark precede.  A word may hold
   many.  Each keeps its neighbours: two words before (only the first of a word), one after, and up to ``NEAR``
   characters of its word on both sides, which end at the candidates next to it.
2. Features: length and length class, shares of character classes, distinct characters, changes
   of class between neighbours (letter to digit, case), runs of one class, coverage by dictionary
   words, signs of a test or sample path in the source, key words and assignment marks in the
   words before, quotes, and the form (hex, digits only, address, path, UUID).
3. The forest is trained on labelled findings: a table (``label``, ``token``, ``before``, ``after``,
   ``source``) of the caller, or ``labelled_findings``, which derives tokens of known kinds from
   digests of row numbers.  Findings under ``threshold`` are removed.

Nothing is shuffled but the findings; the model's size is fixed by its trees and depth.

Results for odd input: a null or empty text has no candidates; a null source is an empty path;
null ids are passed on and share their findings; rows that repeat an id share the findings of
all of them, repeated ones once; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANK, query, settle, table

MIN_LENGTH = 16
MIN_ASSIGNED = 4
NEAR = 64
TOKEN = r"[A-Za-z0-9+/_\-=.~]"
CANDIDATE = (
    rf"(?:(?=[A-Za-z0-9+/_\-=.~]*(?:[0-9]|[a-z][A-Z])){TOKEN}{{{MIN_LENGTH},}})"
    r"|AKIA[0-9A-Z]{12,}|gh[pousr]_[A-Za-z0-9]{10,}|sk_(?:live|test)_|xox[abpr]-|eyJ[A-Za-z0-9_\-]{8,}|AIza[0-9A-Za-z_\-]{20,}"
)
#: What a key word and an assignment mark precede; lookbehinds need bounds.
#: The mark is looked for first: few places have one, and the long lookbehind is dear.
ASSIGNED = (
    r"(?<![A-Za-z0-9])(?<=[:=]>? ?[\"'`]?)"
    r"(?<=(?i:secret|token|passw|passwd|password|passphrase|pwd|key|auth|credential|credentials)[A-Za-z0-9_\-]{0,12}[\"'`]? ?[:=]{1,2}>? ?[\"'`]?)"
    rf"[A-Za-z0-9+/_\-.~!@#$%^*?][A-Za-z0-9+/_\-=.~!@#$%^*?]{{{MIN_ASSIGNED - 1},}}"
)
#: Stand around the candidates of a text; texts do not keep them.
OPEN, CLOSE = "\x01", "\x02"
#: Words that show that a token is spelled, not drawn.
DICTIONARY = (
    "password passwd secret token example sample test dummy changeme your insert here placeholder default user admin name "
    "value string index config server client version release update package module document account customer order number "
    "black white house water light world people point group company system program question government number night area "
    "the and ing tion ment ent for with that this from are was has have not you all can will one out who get time about"
).split()
KEY_WORDS = r"(?i)(secret|token|passw|pwd|api.?key|access.?key|auth|bearer|credential|private|client.?id|key)"
HASH_WORDS = r"(?i)(commit|sha\d*|md5|checksum|digest|hash|etag|uuid|guid|revision|integrity|build|session)"
SAMPLE = r"(?i)(test|example|sample|doc|mock|fixture|demo|dummy)"


def candidates(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, position, place, token, lead, word, before, after) of the candidates of whole texts;
    ``place`` counts them within their word."""
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), OPEN + CLOSE, "\x03\x03")
    text = F.trim(F.regexp_replace(text, BLANK, " "))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), text.alias("text"))
    either = f"{ASSIGNED}|{CANDIDATE}"
    rows = rows.where(F.col("text").rlike(either)).withColumn("text", F.regexp_replace("text", f"({either})", f"{OPEN}$1{CLOSE}"))
    rows = rows.select("id", "source", F.split("text", " ").alias("words"))
    at = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.contains(F.get("words", i), F.lit(OPEN)))
    rows = rows.withColumn("position", F.explode(at))
    plain = lambda word: F.translate(word, OPEN + CLOSE, "")
    before = plain(F.concat_ws(" ", F.get("words", F.col("position") - 2), F.get("words", F.col("position") - 1)))
    after = plain(F.coalesce(F.get("words", F.col("position") + 1), F.lit("")))
    # a part is what stands before the first candidate, or a candidate and what follows it
    rows = rows.select("id", "source", "position", before.alias("before"), after.alias("after"), F.split(F.get("words", F.col("position")), OPEN).alias("parts"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.size("parts") - 1)).alias("place"))
    part, last = F.get("parts", F.col("place")), F.get("parts", F.col("place") - 1)
    token = F.substring_index(part, CLOSE, 1)
    lead = F.right(F.substring_index(last, CLOSE, -1), F.lit(NEAR))
    # name=value is one run of token characters: the name leads where the value is a candidate itself
    value = F.regexp_extract(token, "^[^=]*[A-Za-z0-9_]=(.+)$", 1)
    named = value.rlike(f"^(?:{CANDIDATE})$") | F.concat(lead, token).rlike(KEY_WORDS + r"[A-Za-z0-9_\-]{0,12}=[^=]{" + str(MIN_ASSIGNED) + ",}")
    rows = rows.select(
        "id", "source", "position", "place", "after", F.when(F.col("place") == 1, F.col("before")).otherwise("").alias("before"),
        token.alias("run"), F.when(named, value).otherwise("").alias("value"), lead.alias("lead"), F.left(F.substring_index(part, CLOSE, -1), F.lit(NEAR)).alias("tail"),
    )
    cut = F.col("value") != ""
    token = F.when(cut, F.col("value")).otherwise(F.col("run"))
    lead = F.when(cut, F.concat("lead", F.expr("left(run, length(run) - length(value))"))).otherwise(F.col("lead"))
    rows = rows.select("id", "source", "position", "place", token.alias("token"), lead.alias("lead"), "tail", "before", "after")
    return rows.withColumn("word", F.concat("lead", "token", "tail")).drop("tail")


def _share(column: Column, pattern: str, length: Column) -> Column:
    return F.regexp_count(column, F.lit(pattern)) / length


def _flag(test: Column) -> Column:
    return F.when(test, 1.0).otherwise(0.0)


def feature_columns() -> dict[str, Column]:
    """Features of (``token``, ``lead``, ``word``, ``before``, ``after``, ``source``)."""
    t, word, before = F.col("token"), F.col("word"), F.col("before")
    n = F.greatest(F.length(t), F.lit(1))
    spelled = F.length(F.regexp_replace(F.lower(t), "(" + "|".join(sorted((w for w in DICTIONARY if len(w) > 2), key=len, reverse=True)) + ")", ""))
    lead = F.concat(before, F.lit(" "), F.col("lead"))
    return {
        "length": F.least(n, F.lit(200)).cast("double"),
        "length_class": F.least(F.floor(F.log2(n.cast("double"))), F.lit(10)).cast("double"),
        "digits": _share(t, "[0-9]", n),
        "lower": _share(t, "[a-z]", n),
        "upper": _share(t, "[A-Z]", n),
        "marks": _share(t, "[^A-Za-z0-9]", n),
        "distinct": F.size(F.array_distinct(F.split(t, ""))) / n,
        "to_digit": _share(t, "(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])", n),
        "to_case": _share(t, "(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])", n),
        "long_runs": _share(t, "[a-z]{5,}|[A-Z]{5,}|[0-9]{6,}", n),
        "repeats": _share(t, r"(.)\1", n),
        "vowels": _share(t, "[aeiouAEIOU]", n),
        "spelled": 1 - spelled / n,
        "sample_path": _flag(F.col("source").rlike(SAMPLE)),
        "sample_words": _flag(F.concat(before, F.lit(" "), t).rlike(SAMPLE)),
        "key_words": _flag(lead.rlike(KEY_WORDS)),
        "hash_words": _flag(lead.rlike(HASH_WORDS)),
        "assigned": _flag(F.trim(lead).rlike("[=:]\\s*[\"']?$")),
        "quoted": _flag(word.rlike("[\"'`]")),
        "hex": _flag(t.rlike("^[0-9a-fA-F]+$")),
        "number": _flag(t.rlike("^[0-9.\\-]+$")),
        "address": _flag(word.rlike("(?i)://|www\\.|@|\\.(com|org|net|html?|js|py|png|jpg)\\b")),
        "path": _flag(t.rlike("/[^/]+/") | t.rlike("^[a-z]+([_.-][a-z]+)+$")),
        "uuid": _flag(t.rlike("(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$")),
        "prefix": _flag(t.rlike("^(AKIA|gh[pousr]_|sk_live_|xox[abpr]-|eyJ|AIza)")),
    }


def labelled_findings(spark: SparkSession, rows: int = 6_000) -> DataFrame:
    """Findings of known kinds: keys drawn from digests in the places where keys stand, and hashes,
    identifiers, numbers, addresses, placeholders and spelled names where those do."""
    h = F.sha2(F.concat(F.lit("finding"), F.col("id").cast("string")), 512)
    b64 = F.regexp_replace(F.base64(F.unhex(F.substring(h, 1, 64))), "[\\r\\n]", "")
    pick = lambda values, k: F.element_at(F.array(*map(F.lit, values)), (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(values))) + 1).cast("int"))
    length = (F.pmod(F.xxhash64("id", F.lit(9)), F.lit(40)) + 20).cast("int")
    names = pick(["token = ", "secret: ", "api_key=", "password = ", "the access_key = ", "Authorization: Bearer ", "client_secret = ", "auth token "], 1)
    drawn = {
        0: F.substring(h, 1, 40), 1: F.substring(h, 1, 32), 2: F.substr(b64, F.lit(1), length), 3: F.concat(F.lit("AKIA"), F.upper(F.substring(h, 1, 16))),
        4: F.concat(F.lit("ghp_"), F.substring(F.regexp_replace(b64, "[^A-Za-z0-9]", "x"), 1, 36)), 5: F.concat(F.lit("sk_live_"), F.substring(h, 1, 24)),
        6: F.concat(F.initcap(F.regexp_replace(F.substring(b64, 1, 4), "[^A-Za-z0-9]", "r")), F.substring(h, 1, 2), F.regexp_replace(F.substring(b64, 9, 5), "[^A-Za-z0-9]", "9")),
        7: F.translate(F.substring(h, 1, 32), "0123456789", "ghijklmnop"),
    }
    part = lambda k: pick(DICTIONARY[:40], k)
    false = {
        0: (F.substring(h, 1, 40), pick(["commit ", "revision ", "at commit "], 2)), 1: (F.substring(h, 1, 64), pick(["sha256: ", "checksum ", "digest = "], 2)),
        2: (F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)), pick(["uuid ", "id ", "session "], 2)),
        3: (F.substring(F.conv(F.substring(h, 1, 15), 16, 10), 1, 16), pick(["card ", "number ", "of the ", "and "], 2)),
        4: (F.concat_ws("_", part(3), part(4), part(5), F.lit("1")), pick(["import ", "see ", "the ", "key "], 2)),
        5: (F.concat(F.lit("www."), part(3), part(4), F.lit(".com/"), part(5), F.lit("/12")), pick(["at ", "see ", "from "], 2)),
        6: (pick(["your_secret_token_here1", "xxxxxxxxxxxxxxxxxxxx1", "example-password-123456", "changeme_changeme_1", "00000000000000000000", "1234567890123456"], 3), names),
        7: (F.concat(F.initcap(part(3)), F.initcap(part(4)), F.initcap(part(5)), F.initcap(part(6))), pick(["class ", "new ", "a ", "token "], 2)),
        8: (F.substring(h, 1, 32), pick(["md5 ", "etag: ", "hash "], 2)), 9: (F.concat(part(3), F.lit("."), part(4), F.lit("2024@mail.example.com")), pick(["to ", "from ", "by "], 2)),
        10: (pick(["required", "null", "none", "string", "true", "false", "value", "optional", "missing", "invalid", "expired", "default", "change", "please", "enter"] + DICTIONARY[:40], 3), names),
    }
    base = spark.range(rows).withColumn("kind", F.pmod(F.xxhash64("id", F.lit(0)), F.lit(19)).cast("int"))
    token = F.lit("")
    before = names
    for k, value in drawn.items():
        token = F.when(F.col("kind") == k, value).otherwise(token)
    for k, (value, words) in false.items():
        token = F.when(F.col("kind") == len(drawn) + k, value).otherwise(token)
        before = F.when(F.col("kind") == len(drawn) + k, words).otherwise(before)
    quoted = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(2)) == 0
    mark = F.when(quoted, F.lit('"')).otherwise(F.lit(""))
    source = pick(["src", "src/main", "config", "tests", "docs/example", "web"], 8)
    made = base.select(
        F.col("kind").alias("kind"), token.alias("token"), F.concat(mark, token, mark).alias("word"), F.trim(before).alias("before"),
        pick(["", "and", "in", "the"], 6).alias("after"), F.when(F.col("kind") < len(drawn), pick(["src", "web", "config", "app"], 8)).otherwise(source).alias("source"),
    )
    return made.select("token", "word", "before", "after", "source", (F.col("kind") < len(drawn)).cast("double").alias("label"))


def _assembled(rows: DataFrame) -> DataFrame:
    features = feature_columns()
    if "lead" not in rows.columns:
        rows = rows.withColumn("lead", F.expr("substring(word, 1, greatest(instr(word, token) - 1, 0))"))
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep").transform(rows.withColumns(features))


def fit_secrets(findings: DataFrame, trees: int = 30, depth: int = 9) -> RandomForestClassificationModel:
    """Forest from labelled findings."""
    rows = settle(_assembled(findings).select("label", "features").repartition(4), "secret-train")
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, minInstancesPerNode=2).fit(rows)


def scan_secrets(
    docs: DataFrame, model: RandomForestClassificationModel | None = None, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", threshold: float = 0.5,
) -> DataFrame:
    """One row per input row: id, ``n_candidates``, ``n_secrets``, ``score`` (the highest, 0 without
    candidates), ``secrets`` (position in words, SHA-256 of the token, length, score)."""
    model = model or fit_secrets(labelled_findings(docs.sparkSession))
    rows = settle(candidates(docs, id_col, text_col, source_col).distinct(), "secret-candidates")
    scored = model.transform(_assembled(rows)).select("id", "position", "place", "token", vector_to_array("probability").alias("p"))
    scored = settle(scored, "secret-scores").withColumn("score", F.element_at("p", 2))
    secret = F.struct("position", F.sha2("token", 256).alias("token_sha256"), F.length("token").alias("length"), "score")
    found = scored.groupBy("id").agg(
        F.count("*").alias("n_candidates"), F.max("score").alias("score"),
        F.sort_array(F.collect_list(F.when(F.col("score") >= threshold, secret))).alias("secrets"),
    )
    found = settle(found.withColumnRenamed("id", "__id"), "secret-found")
    out = docs.select(F.col(id_col).alias("id")).join(found, F.col("id").eqNullSafe(F.col("__id")), "left")
    empty = F.array().cast("array<struct<position:int,token_sha256:string,length:int,score:double>>")
    secrets = F.coalesce("secrets", empty)
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"), F.size(secrets).cast("long").alias("n_secrets"),
        F.coalesce("score", F.lit(0.0)).alias("score"), secrets.alias("secrets"),
    )


@query("op7_secret_scan")
def op7_secret_scan(spark, sf_dir):
    return scan_secrets(table(spark, sf_dir, "documents"))
