"""Quality rules with verdicts on hosts.

Each document gets counts from its whole text and a base verdict; failures are aggregated by host, each host's
failure rate is shrunk towards the corpus by an empirical beta prior, and the host verdicts are joined back.

Edge cases: a NULL or empty text has no words and fails the base rules; an empty table gives no rows; repeated
rows are judged one by one; a NULL host belongs to no host and is judged by the base rules alone; columns of other
names are not looked at.  Windows of eight words are compared by a 64-bit hash within their own document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import WORD, join_small, shared, stored, text_of, words_of

WINDOW = 8
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# A host whose shrunk failure rate is above this loses all its documents.
MAX_HOST_RATE = 0.5
# Bounds of the prior's weight in documents.
PRIOR_WEIGHT = (2.0, 10_000.0)


def with_features(docs: DataFrame, text: str = "text", keep: list | None = None) -> DataFrame:
    """``keep`` (all columns unless given) and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    base_failed.  A chain of projections: no shuffle, no Python."""
    keep = docs.columns if keep is None else keep
    base = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], text_of(text).alias("q_text"))
    names = [f"k{i}" for i in range(len(keep))]
    lines = F.filter(F.split("q_text", "\n"), lambda x: x.rlike(WORD))
    d = base.select(*names, "q_text", words_of(F.col("q_text")).alias("q_words"), lines.alias("q_lines"))
    d = d.select(
        *names, F.size("q_words").cast("long").alias("n_words"),
        F.length(F.array_join("q_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("q_text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("q_words", lambda w: F.xxhash64(w)).alias("q_hash"))
    plain = [*names, "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    # one hash for each window of eight words
    starts = F.sequence(F.lit(0), F.size("q_hash") - WINDOW)
    window = F.transform(starts, lambda i: F.xxhash64(*[F.get("q_hash", i + k) for k in range(WINDOW)]))
    d = d.select(*plain, F.when(F.size("q_hash") >= WINDOW, window).alias("q_win"))
    d = d.select(*plain, F.when(F.size("q_win") > F.size(F.array_distinct("q_win")), F.col("q_win")).alias("q_win"))
    # windows found twice or more stand side by side once sorted with their starts
    d = d.select(*plain, F.array_sort(F.transform("q_win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))).alias("q_win"))
    twin = lambda p, j: (F.get("q_win", j - 1)["h"] == p["h"]) | (F.get("q_win", j + 1)["h"] == p["h"])
    found = F.filter("q_win", lambda p, j: F.coalesce(twin(p, j), F.lit(False)))
    found = F.when(F.col("q_win").isNotNull(), F.array_sort(F.transform(found, lambda p: p["i"])))
    d = d.select(*plain, found.alias("q_at"))
    covered = F.transform("q_at", lambda s, j: F.least(F.lit(WINDOW), F.coalesce(F.get("q_at", j + 1) - s, F.lit(WINDOW))))
    d = d.select(*plain, F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))
                 .alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return d.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *counts, failed.alias("base_failed"))


def host_verdicts(judged: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(host, n_docs, n_failed, host_rate, host_failed) for each host that is not NULL.

    The prior is beta(a, b) with the corpus' failure rate as its mean; its weight a + b comes from how far the
    hosts' rates spread beyond what chance alone would spread them."""
    hosts = shared(judged.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host"))
                   .agg(F.count(F.lit(1)).alias("n_docs"), F.count_if("base_failed").alias("n_failed")))
    n, f, h = hosts.agg(F.sum("n_docs"), F.sum("n_failed"), F.count(F.lit(1))).first()
    mean = (f / n) if n else 0.0
    spread = hosts.agg(F.sum(F.col("n_docs") * F.pow(F.col("n_failed") / F.col("n_docs") - F.lit(mean), 2))).first()[0]
    noise = mean * (1 - mean)
    between = max((spread or 0.0) - noise * (h or 0), 0.0) / n if n else 0.0
    weight = min(max(noise / between - 1, PRIOR_WEIGHT[0]), PRIOR_WEIGHT[1]) if between > 0 else PRIOR_WEIGHT[1]
    rate = (F.col("n_failed") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
    return hosts.select("*", rate.alias("host_rate"), (rate > max_rate).alias("host_failed"))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
          max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """doc_id, counts, base_failed and kept, one row per row of ``docs``.  Only ids and counts are kept between
    the pass over the texts and the join with the host verdicts."""
    judged = shared(with_features(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(host).alias("source")),
                                  keep=["doc_id", "source"]))
    verdict = host_verdicts(judged, max_rate=max_rate).select(F.col("host").alias("source"), "host_failed")
    out = join_small(judged, verdict, "source")
    kept = ~F.col("base_failed") & ~F.coalesce("host_failed", F.lit(False))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      kept.alias("kept"))


def filter_docs(docs: DataFrame, text: str = "text", host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns.

    Rows and verdicts are kept in a table in the shared folder, so the texts are judged once and none is shuffled."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("text"), F.col(host).alias("host"))
    marked, _ = stored(with_features(rows, keep=["row", "host"]).select("row", "host", "base_failed"), "judged")
    verdict = host_verdicts(marked.select("host", "base_failed"), host="host", max_rate=max_rate)
    out = join_small(marked.where(~F.col("base_failed")), verdict.where("host_failed").select("host"), "host", "left_anti")
    return out.select("row.*")
