"""Secret scans with DataFrame functions only: three fixed patterns, and character Markov models for the rest.

Two first-order character models, of random strings and of ordinary identifiers, are counted from labelled samples. A
long token outside the patterns' matches is a secret when its log-likelihood ratio (random over ordinary) passes a
margin. Counting is a grouped aggregation; the models have one number per pair of ``ALPHABET``'s characters, so that
they go into the plan as one literal array. Scanning moves no row, so a hot source or a huge text can't skew it.

Null and empty texts have no spans; spans are code points, end exclusive. Rows and other columns stay as they are.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, unused

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
#: What the models judge: whole runs of these characters, 20 of them or more.
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
ALPHABET = string.ascii_letters + string.digits + "+/_=-"
#: Nats of evidence: the log of the prior odds (random strings are rare) plus some more.
MARGIN = 12.0
#: Parts of ordinary identifiers for the default samples.
PARTS = (
    "account address after amount application array attribute average balance base before block branch buffer builder button cache calculate callback category change channel character client collection column command comment "
    "common compare component condition config connection constant container content context controller convert count create current customer data database date default delete description detail device directory display document "
    "domain download duration element email enable entry error event example exception execute expression factory field file filter final find first folder format function general generate global group handler header height history "
    "identifier image import index information initial input insert instance integer interface internal invoice item journal key label language last layout length level library license limit line list loader local location manager "
    "maximum member memory message method minimum model module monitor name network next node notification number object offset operation option order output package page parameter parent parse password path pattern payment period "
    "permission person pointer policy position prefix previous price process product profile program project property provider query queue range reader record reference region register release remote report request resource response "
    "result return role routine sample schedule schema score search section select sequence server service session setting shadow simple source standard start state statistics status storage stream string style subject summary support "
    "switch symbol system table target task template text thread time title total transaction transfer translation type unique update upload user utility validate value variable vector version view visible warning window worker writer"
).split()


def default_samples(spark: SparkSession, n: int = 3000) -> DataFrame:
    """(sample, is_random): ``n`` hashes in hexadecimal, Base64 or capitals, and ``n`` identifiers of ``PARTS`` in usual styles."""
    parts = F.split(F.lit(" ".join(PARTS)), " ")

    def part(k: int) -> Column:
        return F.element_at(parts, (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(PARTS))) + 1).cast("int"))

    words = [part(k) for k in range(5)]
    style = F.pmod(F.col("id"), F.lit(5))
    digest = F.sha2(F.col("id").cast("string"), 256)
    ordinary = F.when(style == 0, F.concat_ws("_", *words)).when(style == 1, F.concat_ws("-", *words)).when(style == 2, F.concat(words[0], *[F.initcap(x) for x in words[1:]])).when(style == 3, F.concat_ws("/", *words)).otherwise(F.concat(*words))
    random = F.when(style == 0, digest).when(style < 4, F.base64(F.unhex(digest))).otherwise(F.upper(F.regexp_replace(F.base64(F.unhex(digest)), "[+/=]", "")))
    ids = spark.range(0, n, 1, 2)
    return ids.select(ordinary.alias("sample"), F.lit(False).alias("is_random")).unionAll(ids.select(random, F.lit(True)))


def fit(samples: DataFrame) -> list[float]:
    """log P(b | a, random) - log P(b | a, ordinary) for each pair of ``ALPHABET``, add-one smoothed; null samples and other characters don't count."""
    pairs = samples.where("sample is not null and is_random is not null").select("is_random", F.explode(F.expr("transform(sequence(1, greatest(length(sample) - 1, 1)), i -> substring(sample, i, 2))")).alias("pair"))
    # at most two rows for each pair of the alphabet
    rows = pairs.where(F.col("pair").rlike(r"\A[A-Za-z0-9+/_=-]{2}\z")).groupBy("is_random", "pair").count().collect()
    counts = {(r["is_random"], r["pair"]): r["count"] for r in rows}
    sums = {(kind, a): sum(counts.get((kind, a + b), 0) for b in ALPHABET) for kind in (True, False) for a in ALPHABET}
    k = len(ALPHABET)

    def log_p(kind: bool, a: str, b: str) -> float:
        return math.log((counts.get((kind, a + b), 0) + 1) / (sums[kind, a] + k))

    return [log_p(True, a, b) - log_p(False, a, b) for a in ALPHABET for b in ALPHABET]


def ratio(token: Column, model: list[float]) -> Column:
    """The log-likelihood ratio of a token of ``ALPHABET``'s characters."""
    letters = F.lit(ALPHABET)
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")  # folded into one literal
    codes = F.transform(F.split(token, ""), lambda c: F.instr(letters, c))
    return F.aggregate(
        codes,
        F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum")),
        lambda acc, c: F.struct(c.alias("last"), (acc["sum"] + F.when((acc["last"] > 0) & (c > 0), F.element_at(table, F.greatest((acc["last"] - 1) * len(ALPHABET) + c, F.lit(1)))).otherwise(0.0)).alias("sum")),
        lambda acc: acc["sum"],
    )


SPANS = "array<struct<s: int, kind: int, e: int>>"
#: Hits that one step of a running sum takes; sums over steps come first, so that no array grows by one for each hit.
CHUNK = 256
#: What may stand for a masked character (none of any pattern's): the first that the text doesn't have, or, where it has
#: all of these, the first character from U+10000 on that it doesn't have.
BLANKS = "\u0000\u0001\u0002\u0003\ue000\ue001\ue002\ue003"


def _found(pieces: Column, hits: Column, kind: int) -> Column:
    """The spans of matches, from what lies between them and what they are."""
    sizes = F.zip_with(F.slice(pieces, 1, F.size(hits)), hits, lambda p, h: F.struct(F.length(p).alias("p"), F.length(h).alias("h")))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / CHUNK).cast("int")), lambda i: F.slice(sizes, i * CHUNK + 1, CHUNK))
    totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda n, x: n + x["p"] + x["h"]))
    starts = F.aggregate(totals, F.array(F.lit(0)), lambda out, n: F.concat(out, F.array(F.element_at(out, -1) + n)))

    def spans(chunk: Column, start: Column) -> Column:
        return F.aggregate(
            chunk,
            F.struct(start.alias("at"), F.lit(None).cast(SPANS).alias("out")),
            lambda acc, x: F.struct((acc["at"] + x["p"] + x["h"]).alias("at"), F.concat(F.coalesce(acc["out"], F.expr(f"cast(array() as {SPANS})")), F.array(F.struct((acc["at"] + x["p"]).alias("s"), F.lit(kind).alias("kind"), (acc["at"] + x["p"] + x["h"]).alias("e")))).alias("out")),
            lambda acc: acc["out"],
        )

    return F.flatten(F.zip_with(chunks, F.slice(starts, 1, F.size(chunks)), spans))


def _long(hits: Column, least: int) -> Column:
    """Whether each match has ``least`` characters (a lambda of two parameters would get the match's place as the second)."""
    return F.transform(hits, lambda x: F.length(x) >= least)


def _masked(text: Column, blank: Column, regex: str, hits: Column, wanted: Column) -> Column:
    """``text`` with the wanted matches blanked, length kept."""
    pieces = F.split(text, regex, -1)
    out = F.zip_with(hits, wanted, lambda h, w: F.when(w, F.repeat(blank, F.length(h))).otherwise(h))
    return F.array_join(F.zip_with(pieces, out, lambda p, h: F.concat(p, F.coalesce(h, F.lit("")))), "")


def _blank(text: Column) -> Column:
    usual = F.get(F.filter(F.array(*[F.lit(x) for x in BLANKS]), lambda x: ~text.contains(x)), F.lit(0))
    own = F.array_distinct(F.split(text, ""))
    others = F.transform(F.sequence(F.lit(0x10000), F.least(F.lit(0x10000) + F.size(own), F.lit(0x10FFFF))), lambda i: F.decode(F.unhex(F.lpad(F.hex(i), 8, "0")), "UTF-32"))
    return F.coalesce(usual, F.get(F.array_except(others, own), F.lit(0)))


def _names(docs: DataFrame) -> dict[str, str]:
    """Names of the scan's own columns that none of ``docs`` has."""
    return {k: unused(docs, f"__{k}") for k in ("spans", "text", "named", "runs", "values", "blank", "assign", "access", "hex", "n_base", "masked", "tokens", "secret")}


def find(docs: DataFrame, model: list[float] | None = None, *, text_col: str = "text", out: str = "__spans") -> DataFrame:
    """All columns and ``out``: array<struct<s, kind, e>> sorted by start, then kind (0 to 3 as in ``KINDS``)."""
    names = _names(docs)
    return _scanned(docs, model, text_col, names).select(*docs.columns, F.col(names["spans"]).alias(out))


def _scanned(docs: DataFrame, model: list[float] | None, text_col: str, c: dict[str, str]) -> DataFrame:
    """``docs``, and under the names ``c`` the spans, the text without base spans, its long tokens and whether each is secret."""
    model = model if model is not None else fit(default_samples(docs.sparkSession))
    none, t = F.expr(f"cast(array() as {SPANS})"), F.col(c["text"])
    strings = F.expr("cast(array() as array<string>)")
    df = docs.withColumn(c["text"], F.coalesce(F.col(text_col), F.lit("")))
    low = F.lower(t)
    named = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api_key") | low.contains("apikey")
    df = df.withColumns({c["blank"]: _blank(t), c["named"]: named, c["runs"]: F.size(F.regexp_extract_all(t, F.lit(TOKEN), F.lit(0))) > 0})

    def hits(regex: str, might: Column, group: int = 0) -> Column:
        return F.when(might, F.regexp_extract_all(t, F.lit(regex), F.lit(group))).otherwise(strings)

    df = df.withColumns({c["assign"]: hits(ASSIGN, F.col(c["named"])), c["values"]: hits(ASSIGN, F.col(c["named"]), 2), c["access"]: hits(ACCESS, t.contains("AKIA")), c["hex"]: hits(HEX, F.col(c["runs"]))})
    wanted = {"assign": _long(F.col(c["values"]), 8), "access": _long(F.col(c["access"]), 16), "hex": F.transform(c["hex"], lambda k: F.lit(True))}

    def base(name: str, regex: str, kind: int) -> Column:
        fine = F.filter(F.zip_with(_found(F.split(t, regex, -1), F.col(c[name]), kind), wanted[name], lambda x, w: F.when(w, x)), lambda x: x.isNotNull())
        return F.when(F.size(c[name]) > 0, fine).otherwise(none)

    df = df.withColumn(c["spans"], F.concat(base("assign", ASSIGN, 0), base("access", ACCESS, 1), base("hex", HEX, 2)))
    # base spans are blanked one kind after the other, and what remains of a long run is judged by itself
    df = df.withColumns({c["n_base"]: F.size(c["spans"]), c["masked"]: F.when(F.size(c["spans"]) > 0, F.when(F.size(c["assign"]) > 0, _masked(t, F.col(c["blank"]), ASSIGN, F.col(c["assign"]), wanted["assign"])).otherwise(t)).otherwise(t)})
    m = F.col(c["masked"])
    for kind, regex, least in (("access", ACCESS, 16), ("hex", HEX, 32)):
        again = F.regexp_extract_all(m, F.lit(regex), F.lit(0))
        df = df.withColumn(c["masked"], F.when(F.size(c[kind]) > 0, _masked(m, F.col(c["blank"]), regex, again, _long(again, least))).otherwise(m))
    df = df.withColumn(c["tokens"], F.when(F.col(c["runs"]), F.regexp_extract_all(m, F.lit(TOKEN), F.lit(0))).otherwise(strings))
    df = df.withColumn(c["secret"], F.transform(c["tokens"], lambda x: ratio(x, model) > MARGIN))
    judged = F.filter(F.zip_with(_found(F.split(m, TOKEN, -1), F.col(c["tokens"]), 3), F.col(c["secret"]), lambda x, w: F.when(w, x)), lambda x: x.isNotNull())
    return df.withColumn(c["spans"], F.array_sort(F.when(F.size(c["tokens"]) > 0, F.concat(c["spans"], judged)).otherwise(F.col(c["spans"]))))


def shown(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def redact(docs: DataFrame, model: list[float] | None = None, *, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns; in ``text_col``, each stretch of overlapping or touching spans is replaced by ``mark``."""
    c = _names(docs)
    df = _scanned(docs, model, text_col, c)
    blank = F.when(F.size(c["tokens"]) > 0, _masked(F.col(c["masked"]), F.col(c["blank"]), TOKEN, F.col(c["tokens"]), F.col(c["secret"]))).otherwise(F.col(c["masked"]))
    cut = F.regexp_replace(blank, F.concat(c["blank"], F.lit("+")), F.lit(mark.replace("\\", "\\\\").replace("$", "\\$")))
    return df.select(*[F.when(F.size(c["spans"]) > 0, cut).otherwise(F.col(x)).alias(x) if x == text_col else F.col(x) for x in docs.columns])


def scan(docs: DataFrame, model: list[float] | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_assign, n_access, n_hex, base_sha256, spans, n_markov of each row."""
    df = find(docs.select(id_col, text_col), model, text_col=text_col)

    def of(kind: int) -> Column:
        return F.size(F.filter("__spans", lambda x: x["kind"] == kind)).cast("long")

    count = {f"n_{k}": of(i) for i, k in enumerate(KINDS)}
    return df.select(id_col, *[count[f"n_{k}"].alias(f"n_{k}") for k in KINDS[:3]], F.sha2(shown(F.filter("__spans", lambda x: x["kind"] < 3)), 256).alias("base_sha256"), shown(F.col("__spans")).alias("spans"), count["n_markov"].alias("n_markov"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))
