"""Host-level quality rules.

Every document is measured and held against a few rules; failures are added up by host,
the failure rates are shrunk towards a beta prior fitted to all hosts by the method of
moments, and a host whose shrunk rate passes a rule's limit loses its documents. A host
with few documents therefore needs strong evidence, a large one is judged by its own.

Beside that every document answers for itself: one that fails a rule goes, unless the shrunk
rate of its host's other documents shows that failing this rule is normal there. Junk in a mixed host goes and the
host's clean documents stay. Failing ``short`` or ``repeats`` (``base_failed``) is never excused.

Only SQL functions run. The text is read once; the rest works on one narrow row a document.

Defined results: a NULL text has no words; a NULL host is a host of its own; repeated rows
are judged row by row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, SPACES, Workspace, keyed, pinned, words

#: Highest shrunk failure rate of a host by rule; a host above any of them is rejected.
LIMITS = {"short": 0.5, "repeats": 0.5, "symbols": 0.5, "lines": 0.5, "lengths": 0.5}
#: Shrunk failure rate of a document's host, without itself, from which failing a rule is normal there.
NORMAL = 0.3
#: Rules whose failure no host excuses.
BASE = ("short", "repeats")
#: Strength of the prior, in documents: at least and at most.
STRENGTH = (1.0, 1e6)

RULES = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "100 * n_dup_lines > 30 * n_lines",
    "lengths": "word_chars < 2 * n_words or word_chars > 15 * n_words",
}


def _has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES)) != ""


def measure(df: DataFrame, text: str) -> DataFrame:
    """Replace the column ``text`` by n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    rest = [F.col(c) for c in df.columns if c != text]
    whole = F.coalesce(F.col(text), F.lit(""))
    step = df.select(
        *rest, words(F.col(text)).alias("_words"),
        F.filter(F.split(whole, "\n"), _has_word).alias("_lines"),
        (F.octet_length(whole) - F.octet_length(F.regexp_replace(whole, r"[#*$%&|<>]+", "")))
        .cast("long").alias("n_symbols"))
    step = step.select(
        *rest, "n_symbols", "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.concat_ws("", "_words")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr("""case when size(_words) < 3 then cast(array() as array<bigint>)
                  else transform(sequence(0, size(_words) - 3),
                                 i -> xxhash64(_words[i], _words[i + 1], _words[i + 2])) end""").alias("_windows"))
    rest += [F.col(c) for c in ("n_symbols", "n_words", "word_chars", "n_lines", "n_dup_lines")]
    # Only windows that occur twice are sorted out by place; most texts have few.
    step = step.select(*rest, F.expr("""
        case when size(array_distinct(_windows)) = size(_windows) then null
             else array_sort(transform(_windows, (h, i) -> struct(h as h, i as i))) end""").alias("_sorted"))
    step = step.select(*rest, F.expr("""
        filter(transform(_sorted, (x, k) ->
            case when (k > 0 and _sorted[k - 1].h = x.h)
                   or (k < size(_sorted) - 1 and _sorted[k + 1].h = x.h) then x.i end),
            i -> i is not null)""").alias("_twice"))
    return step.select(*rest, F.expr("""
        case when _twice is null then 0L
             else cast(size(array_distinct(flatten(transform(_twice, i -> array(i, i + 1, i + 2))))) as bigint)
        end""").alias("n_repeat_words"))


def host_rates(measured: DataFrame, limits: dict[str, float] = LIMITS) -> DataFrame:
    """One row a host: n_docs, and for each rule its failures and shrunk rate; ``host_ok``; ``normal``, the rules
    whose failure the host excuses."""
    hosts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum(F.expr(f"cast({RULES[r]} as bigint)")).alias(f"{r}_failures") for r in limits])
    sums = [F.sum("n_docs").alias("n"), F.count(F.lit(1)).alias("hosts")]
    for r in limits:
        f, n = F.col(f"{r}_failures"), F.col("n_docs")
        sums += [F.sum(f).alias(f"{r}_f"), F.sum(f * f / n).alias(f"{r}_ff")]
    total = hosts.agg(*sums).first()
    ok = F.lit(True)
    columns, normal = [], []
    for r, limit in limits.items():
        if not total["n"]:
            break
        mean = total[f"{r}_f"] / total["n"]
        spread = mean * (1 - mean)
        # Variance of the hosts' rates beyond what binomial counts alone would show.
        between = (total[f"{r}_ff"] / total["n"] - mean * mean) - spread * total["hosts"] / total["n"]
        strength = min(max(spread / between - 1 if between > 0 else STRENGTH[1], STRENGTH[0]), STRENGTH[1])
        rate = (F.col(f"{r}_failures") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
        columns.append(rate.alias(f"{r}_rate"))
        ok &= rate <= limit
        if r not in BASE:
            others = (F.col(f"{r}_failures") - 1 + F.lit(mean * strength)) / (F.col("n_docs") - 1 + F.lit(strength))
            normal.append(F.when(others >= NORMAL, F.lit(r)))
    excused = F.array_compact(F.array(*normal)) if normal else F.array().cast("array<string>")
    return hosts.select("*", *columns, ok.alias("host_ok"), excused.alias("normal"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          limits: dict[str, float] = LIMITS, ws: Workspace | None = None) -> DataFrame:
    """One row a document: its row key, doc_id, the measures, base_failed, host_ok, own_ok, kept."""
    ws = ws or Workspace(docs.sparkSession, "host-rules")
    narrow = keyed(pinned(ws, docs), F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"),
                   F.col(text_col).alias("_text"))
    measured = ws.keep(measure(narrow, "_text"), "measured")
    verdicts = ws.keep(host_rates(measured, limits).select(
        F.col("host").alias("_host"), "host_ok", F.col("normal").alias("_normal")), "hosts")
    own_ok = F.lit(True)
    for r in limits:
        if r not in BASE:
            own_ok &= ~F.expr(RULES[r]) | F.array_contains("_normal", r)
    return (measured.join(verdicts, F.col("host").eqNullSafe(F.col("_host")))
            .withColumn("base_failed", F.expr(" or ".join(RULES[r] for r in BASE)))
            .withColumn("own_ok", own_ok)
            .withColumn("kept", F.expr("not base_failed and host_ok and own_ok"))
            .drop("_host", "_normal"))


def keep_good(docs: DataFrame, **columns) -> DataFrame:
    """The documents that ``judge`` keeps, with all their columns."""
    ws = Workspace(docs.sparkSession, "host-rules")
    docs = pinned(ws, docs)
    kept = ws.keep(judge(docs, ws=ws, **columns).where("kept").select(ROW), "kept")
    return (docs.join(kept.hint("merge"), ROW, "left_semi").drop(ROW))
