"""Secret scans: base rules plus character Markov models.

Base rules find assignments, access keys and long hex strings.  Beside them, runs of 20 or more token characters
are scored by two character bigram models, one of random strings and one of ordinary identifiers; a run whose log
likelihood ratio favours the random model clearly is a span of kind ``markov``.  The models are counted from
labelled samples: what the base rules find is labelled random, other runs of letters, digits and signs are labelled
ordinary.  All of it is column expressions; no Python runs on the executors.

Edge cases: a NULL or empty text has no spans; an empty table gives no rows; without labelled random strings
that model is uniform, and without ordinary ones nothing is added; repeated rows are scanned one by one;
positions count code points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import fresh, text_of, unit_hash

# The base patterns and the least length of what they must match (assign: of its value).
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
KINDS = ["assign", "access", "hex", "markov"]

# Runs that the models look at, and runs that they learn ordinary identifiers from.
RUN = r"[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = r"[A-Za-z0-9+/_=-]{6,}"
# At most about this many documents are used to count the models.
TRAIN_DOCS = 20_000
# Log likelihood ratio (nats) a run must reach, in all and for each pair of characters.
MIN_LLR, MIN_MEAN_LLR = 15.0, 0.7
SMOOTHING, BACKOFF = 0.5, 5.0
# What is added to the count of each character of random strings: few samples don't make them less than random.
RANDOM_PRIOR = 20.0
# Characters from '+' to 'z' index the bigram tables.
LOW, SPAN = 43, 80
BLOCK = 512


def _positions(gaps_hits: str) -> Column:
    """Spans (s, e) from an array of (gap, len) in text order; blocks keep the work near-linear for many matches."""
    pairs = F.col(gaps_hits)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / BLOCK).cast("int")),
                         lambda j: F.slice(pairs, j * BLOCK + 1, F.lit(BLOCK)))
    size = lambda x: F.aggregate(x, F.lit(0), lambda a, e: a + e["g"] + e["l"])
    begins = F.aggregate(blocks, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + size(x))))

    def within(x, begin):
        none = F.array().cast("array<struct<s:int,e:int>>")
        step = lambda a, e: F.struct(
            (a["p"] + e["g"] + e["l"]).alias("p"),
            F.concat(a["o"], F.array(F.struct((a["p"] + e["g"]).alias("s"), (a["p"] + e["g"] + e["l"]).alias("e")))).alias("o"))
        return F.aggregate(x, F.struct(begin.alias("p"), none.alias("o")), step, lambda a: a["o"])

    return F.flatten(F.zip_with(blocks, F.slice(begins, F.lit(1), F.size(blocks)), within))


def _find(df: DataFrame, name: str, pattern: str, quick: str, extra: str | None = None) -> DataFrame:
    """Add ``name``: spans (s, e, t, x) of the pattern's matches, t the text and x the group named by ``extra``;
    NULL where ``quick`` does not match."""
    hit = F.col("s_text").rlike(quick)
    d = df.select("*", F.when(hit, F.regexp_extract_all("s_text", F.lit(pattern), F.lit(0))).alias("f_hits"))
    other = F.regexp_extract_all("s_text", F.lit(pattern), F.lit(int(extra))) if extra else F.col("f_hits")
    d = d.select("*", F.when(F.size("f_hits") > 0, F.split("s_text", pattern, -1)).alias("f_parts"),
                 F.when(F.size("f_hits") > 0, other).alias("f_other"))
    pairs = F.transform("f_hits", lambda h, i: F.struct(F.length(F.get("f_parts", i)).alias("g"), F.length(h).alias("l")))
    d = d.select("*", F.when(F.size("f_hits") > 0, pairs).alias("f_pairs"))
    d = d.select("*", F.when(F.col("f_pairs").isNotNull(), _positions("f_pairs")).alias("f_at"))
    spans = F.transform("f_at", lambda p, i: F.struct(p["s"].alias("s"), p["e"].alias("e"), F.get("f_hits", i).alias("t"),
                                                      F.get("f_other", i).alias("x")))
    return d.select("*", spans.alias(name)).drop("f_hits", "f_parts", "f_other", "f_pairs", "f_at")


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with s_text and arrays assign, access, hex of (s, e, t, x), each NULL when empty."""
    d = docs.withColumn("s_text", text_of(text))
    d = _find(d, "assign", ASSIGN, ASSIGN, "2")
    d = d.withColumn("assign", F.filter("assign", lambda p: F.length(p["x"]) >= MIN_ASSIGN))
    # a run of the class is matched from its first possible start, so a least length in the pattern finds the same
    d = _find(d, "access", "AKIA[A-Z0-9]{%d,}" % (MIN_ACCESS - 4), "AKIA[A-Z0-9]{%d,}" % (MIN_ACCESS - 4))
    return _find(d, "hex", "[0-9a-f]{%d,}" % MIN_HEX, "[0-9a-f]{%d}" % MIN_HEX)


def _bigrams(tokens: DataFrame) -> DataFrame:
    """(random, pair, n) counted over (random, token)."""
    pairs = tokens.where(F.length("token") >= 2).select(
        "random", F.explode(F.transform(F.sequence(F.lit(1), F.length("token") - 1),
                                        lambda i: F.substring("token", i, F.lit(2)))).alias("pair"))
    return pairs.groupBy("random", "pair").agg(F.count(F.lit(1)).alias("n"))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = TRAIN_DOCS) -> list[float]:
    """The table of log likelihood ratios by pair of characters (SPAN * SPAN numbers), from a sample of about
    ``sample`` documents chosen by a hash of their id.  Only counts by pair reach the driver: at most 2 * SPAN**2."""
    total = docs.count()
    share = min(1.0, sample / total) if total else 1.0
    part = docs.where(unit_hash("secrets", F.col(doc_id)) < F.lit(share)).select(F.col(text).alias("text"))
    b = base_spans(part).select("s_text", *KINDS[:3])
    values = F.concat(*[F.coalesce(F.transform(k, lambda p: p["x"]), F.array().cast("array<string>")) for k in KINDS[:3]])
    rest = F.when(F.size(values) == 0, F.regexp_extract_all("s_text", F.lit(IDENTIFIER), F.lit(0)))
    labelled = b.select(F.array_distinct(values).alias("v"), rest.alias("r"))  # a document's repeats say nothing new
    tokens = labelled.select(F.explode(F.concat(
        F.transform("v", lambda t: F.struct(F.lit(True).alias("random"), t.alias("token"))),
        F.coalesce(F.transform("r", lambda t: F.struct(F.lit(False).alias("random"), t.alias("token"))),
                   F.array().cast("array<struct<random:boolean,token:string>>")))).alias("x")).select("x.*")
    counts: dict[bool, dict[tuple[int, int], int]] = {True: {}, False: {}}
    for r in _bigrams(tokens).collect():
        a, b_ = ord(r["pair"][0]) - LOW, ord(r["pair"][1]) - LOW
        if 0 <= a < SPAN and 0 <= b_ < SPAN:
            counts[r["random"]][(a, b_)] = r["n"]
    if not counts[False]:
        return [0.0] * (SPAN * SPAN)
    used = [i for i in range(SPAN) if chr(LOW + i).isalnum() or chr(LOW + i) in "+/_=-."]
    sums, singles = {}, {}
    for k, c in counts.items():
        sums[k], second = [0] * SPAN, [0] * SPAN
        for (a, b_), n in c.items():
            sums[k][a] += n
            second[b_] += n
        more = RANDOM_PRIOR if k else SMOOTHING
        singles[k] = [(n + more) / (sum(second) + more * len(used)) for n in second]

    def log_p(k, a, b_):  # pairs that are rare fall back on how frequent the second character is
        return math.log((counts[k].get((a, b_), 0) + BACKOFF * singles[k][b_]) / (sums[k][a] + BACKOFF))

    return [log_p(True, a, b_) - log_p(False, a, b_) for a in range(SPAN) for b_ in range(SPAN)]


def find_secrets(docs: DataFrame, model: list[float], text: str = "text", found_as: str = "s_found") -> DataFrame:
    """The columns of ``docs`` and ``found_as`` (no name among these): base and added spans (s, e, k) in text
    order, k the index in KINDS."""
    names = [f"k{i}" for i in range(len(docs.columns))]
    d = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)], F.col(f"`{text}`").alias("in_text"))
    d = base_spans(d, "in_text")
    kind = lambda c, k: F.coalesce(F.transform(c, lambda p: F.struct(p["s"].alias("s"), p["e"].alias("e"), F.lit(k).alias("k"))),
                                   F.array().cast("array<struct<s:int,e:int,k:int>>"))
    d = d.select(*names, "s_text", F.sort_array(F.concat(*[kind(c, k) for k, c in enumerate(KINDS[:3])])).alias("s_base"))
    d = _find(d, "run", RUN, RUN)
    ratios = F.expr("array(" + ",".join(f"{x:.6f}D" for x in model) + ")")
    code = lambda t, i: F.ascii(F.substring(t, i, F.lit(1))) - LOW
    score = lambda t: F.aggregate(F.sequence(F.lit(1), F.length(t) - 1), F.lit(0.0),
                                  lambda a, i: a + F.get(ratios, code(t, i) * SPAN + code(t, i + 1)))
    free = lambda p: ~F.exists("s_base", lambda b: (b["s"] < p["e"]) & (p["s"] < b["e"]))
    d = d.withColumn("run", F.filter("run", free))
    scored = F.transform("run", lambda p: F.struct(p["s"].alias("s"), p["e"].alias("e"), score(p["t"]).alias("x")))
    d = d.select(*names, "s_base", scored.alias("run"))
    d = d.withColumn("run", F.filter("run", lambda p: (p["x"] >= MIN_LLR) & (p["x"] >= MIN_MEAN_LLR * (p["e"] - p["s"] - 1))))
    found = F.array_sort(F.concat("s_base", kind("run", 3)))
    return d.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)],
                    F.transform(found, lambda p: F.struct(p["s"].alias("s"), p["e"].alias("e"), p["k"].alias("k"))).alias(found_as))


def spans_text(found: Column) -> Column:
    """kind:start:end joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda p: F.concat_ws(":", F.get(names, p["k"]), p["s"], p["e"])), ",")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans: one row per row of ``docs``."""
    part = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    d = find_secrets(part, train(part)).drop("text")
    n = lambda k: F.size(F.filter("s_found", lambda p: p["k"] == k)).cast("long")
    return d.select("doc_id", *[n(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                    F.sha2(spans_text(F.filter("s_found", lambda p: p["k"] < 3)), 256).alias("base_sha256"),
                    spans_text(F.col("s_found")).alias("spans"))


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each found span of its text replaced by ``mark`` (overlapping spans by one); a column n_chars,
    if there is one, follows the text.  Texts without spans are unchanged, NULL included."""
    spans = fresh(docs, "s_found")[0]
    d = find_secrets(docs, train(docs, doc_id, text), text, spans)

    def step(a, p):
        piece = F.concat(F.substring(text, a["p"] + 1, p["s"] - a["p"]), F.lit(mark))
        return F.struct(F.greatest(a["p"], p["e"]).alias("p"),
                        F.concat(a["o"], F.when(p["s"] >= a["p"], piece).otherwise(F.lit(""))).alias("o"))

    start = F.struct(F.lit(0).alias("p"), F.lit("").alias("o"))
    clean = F.aggregate(spans, start, step, lambda a: F.concat(a["o"], F.substring(text, a["p"] + 1, F.length(text))))
    d = d.withColumn(text, F.when(F.size(spans) > 0, clean).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        d = d.withColumn("n_chars", F.when(F.size(spans) > 0, F.length(text).cast("long")).otherwise(F.col("n_chars")))
    return d.select(*[F.col(f"`{c}`") for c in docs.columns])
