"""Serving queries over the snapshot: counters, filters, ranking, paging, lookup."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil import constants as C
from vigil.functions import rounding as R
from vigil.functions import scoring as S
from vigil.operators.ranking import publish, published_rows, ranges_of, with_position

# Score buckets a page is located by: width 1/1000, scores outside 0..10 share the outer ones.
SCORE_STEPS = 1000
SCORE_TOP = 10
PAGE_SORT_ROWS = 100_000   # rows before a page, in the score bucket where it starts, that are sorted at most
REFINE_BINS = 4096         # parts that a range of a ranking key is cut into


def summary(store: DataFrame) -> DataFrame:
    """V1: total, CVEs, IPs and predicted-Critical counts in one aggregate."""
    return store.agg(
        F.count(F.lit(1)).alias("total_threats"),
        F.count_if(F.col("threat_type") == C.TYPE_CVE).alias("cves"),
        F.count_if(F.col("threat_type") == C.TYPE_IP).alias("malicious_ips"),
        F.count_if(F.col("predicted_priority") == "Critical").alias("critical_priority"))


def distinct_types(store: DataFrame) -> DataFrame:
    """V2: distinct non-null threat types, ascending."""
    return (store.select("threat_type").filter(F.col("threat_type").isNotNull())
            .distinct().orderBy("threat_type"))


def available_priorities(store: DataFrame) -> DataFrame:
    """V3: fixed order Critical→Low ∩ present predictions; all four when none present.

    The present set is filtered to the four labels before ``distinct``, so at
    most four rows ever leave the aggregate.
    """
    spark = store.sparkSession
    fixed = spark.createDataFrame(list(enumerate(C.DISPLAY_PRIORITY_ORDER)),
                                  "display_order int, priority string")
    present = (store.select(F.col("predicted_priority").alias("priority"))
               .filter(F.col("priority").isin(*C.PRIORITY_LABELS)).distinct()
               .withColumn("_present", F.lit(True)))
    j = fixed.join(F.broadcast(present), "priority", "left")
    any_present = j.agg(F.count_if(F.col("_present")).alias("_k"))
    return (j.crossJoin(F.broadcast(any_present))
            .filter(F.col("_present") | (F.col("_k") == 0))
            .select("display_order", "priority"))


def filter_threats(store: DataFrame, types: list[str] | None = None,
                   priorities: list[str] | None = None) -> DataFrame:
    """V4: IN-list filters.  Defaults select every type and every label, so a
    row without a prediction never passes.  A table without the prediction
    column is filtered by type only."""
    t = F.col("threat_type").isin(*types) if types is not None else F.col("threat_type").isNotNull()
    if "predicted_priority" not in store.columns:
        return store.filter(t)
    p = F.col("predicted_priority").isin(*(priorities if priorities is not None
                                           else C.PRIORITY_LABELS))
    return store.filter(t & p)


def rank_key_spec(df: DataFrame, desc: bool = True) -> list[tuple[str, Column, bool]]:
    """V5 order as (name, expression, descending): label rank (3..0, else -1), score,
    then table order (batch_id, seq) and id.  NULLs sort last in every key.

    Without a score column severity takes its place; without a label column
    severity alone ranks.
    """
    labelled = "predicted_priority" in df.columns
    score = "predicted_priority_score" if labelled and "predicted_priority_score" in df.columns else "severity_raw"
    rank = F.coalesce(S.label_rank(F.col("predicted_priority")), F.lit(-1)) if labelled \
        else F.coalesce(F.lit(None).cast("int"), F.lit(-1))       # a bare number would be read as a column position
    return [("_rank", rank, desc), ("_score", F.col(score), desc), ("batch_id", F.col("batch_id"), False),
            ("seq", F.col("seq"), False), ("id", F.col("id"), False)]


def rank_keys(df: DataFrame, desc: bool = True) -> list[Column]:
    return [e.desc_nulls_last() if d else e.asc_nulls_last() for _, e, d in rank_key_spec(df, desc)]


def rank_threats(df: DataFrame, desc: bool = True, columns: list[str] | None = None) -> DataFrame:
    """V5: the filtered set with its 1-based ``position`` in the ranking.

    Only the ranking keys and ``columns`` (default: id, type, prediction) travel
    through the range shuffle.
    """
    names = columns or [c for c in ("id", "threat_type", "predicted_priority", "predicted_priority_score")
                        if c in df.columns]
    keys = [c for c in ("predicted_priority", "predicted_priority_score", "severity_raw", "batch_id", "seq", "id")
            if c in df.columns]
    narrow = df.select(*dict.fromkeys([*names, *keys]))
    return with_position(narrow, rank_keys(narrow, desc)).select(*names, "position")


def publish_ranking(store: DataFrame, path: str, desc: bool = True, num_partitions: int | None = None) -> int:
    """V5 kept as a table: the whole filtered set in its ranking, written once (say, at a commit) and paged from there."""
    n = num_partitions or int(store.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return publish(store, rank_keys(store, desc), path, n)


def published_page(spark, path: str, page_no: int, size: int = C.DEFAULT_PAGE_SIZE) -> DataFrame:
    """V6 from a published ranking: the files of the page's range, no sort and no count."""
    b = page_bounds(sum(n for _, _, n in ranges_of(spark, path)), page_no, size)
    return published_rows(spark, path, b["start_row"] - 1, b["end_row"])


def page_bounds(total: int, page: int, size: int) -> dict[str, int]:
    """V6/V7 arithmetic: pages = max(1, ceil(total/size)); out-of-range page → 1."""
    pages = max(1, math.ceil(total / size))
    if page > pages or page < 1:
        page = 1
    start = (page - 1) * size
    end = min(start + size, total)
    return {"page": page, "page_size": size, "start_row": start + 1, "end_row": end,
            "total_rows": total, "total_pages": pages}


def page(df: DataFrame, page_no: int, size: int = C.DEFAULT_PAGE_SIZE, desc: bool = True,
         sort_rows: int = PAGE_SORT_ROWS) -> DataFrame:
    """V6: rows of one page with their position, at any depth.

    The rows are counted by (label rank, score bucket), a table of bounded
    size; it gives the total and the buckets that the page touches, and only
    the rows of these buckets are sorted.  Where more than ``sort_rows`` of them
    lie before the page (mass ties, as few features give them), the row that the
    page starts with is found by counting (``kth_row``) and the page is the top
    rows from there on, so that no task sorts or keeps more than ``sort_rows`` + a page.
    """
    spec = rank_key_spec(df, desc)
    rank, score = (e for _, e, _ in spec[:2])
    # greatest() and least() skip NULLs, so a missing score is kept apart first
    step = F.when(score.isNotNull(), F.floor(F.least(F.greatest(score, F.lit(0.0)), F.lit(float(SCORE_TOP))) * SCORE_STEPS))
    code = rank.cast("bigint") * F.lit(1 << 32) + F.coalesce(step, F.lit(-1))
    seen = df.groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n"), F.max(rank).alias("r"),
                                              F.max(step).alias("s")).collect()
    b = page_bounds(sum(r["n"] for r in seen), page_no, size)
    start, end = b["start_row"] - 1, b["end_row"]
    sign = -1 if desc else 1
    before, skipped, touched = 0, 0, []
    for r in sorted(seen, key=lambda r: (sign * r["r"], r["s"] is None, sign * (r["s"] or 0))):
        if before + r["n"] <= start:
            skipped += r["n"]
        elif before < end:
            touched.append((r["code"], r["n"]))
        before += r["n"]
    keys, part = rank_keys(df, desc), df.filter(code.isin([c for c, _ in touched]))
    offset = start - skipped
    if touched and offset > sort_rows:
        # the first bucket holds the page's first row
        cursor = kth_row(df.filter(code == F.lit(touched[0][0])), spec, offset, touched[0][1], sort_rows)
        part, offset = part.filter(_beyond(spec, cursor, itself=True)), 0
    top = part.orderBy(*keys).limit(offset + end - start).offset(offset)
    # At most ``size`` rows here; a keyless window over them is trivially small.
    return top.withColumn("position", F.row_number().over(Window.orderBy(*keys)) + start)


def kth_row(df: DataFrame, spec: list[tuple[str, Column, bool]], k: int, n: int, sort_rows: int) -> dict:
    """Ranking keys of the row with ``k`` rows before it, of the ``n`` rows of ``df``.

    Key by key, the range that holds the row is cut into ``REFINE_BINS`` counted parts and narrowed to one of them,
    down to a single value; the next key then splits those ties.  As soon as the range holds at most ``sort_rows``
    rows, these are sorted.  The counts are at most ``REFINE_BINS`` rows a round.
    """
    for name, key, descending in spec:
        if n <= sort_rows or name == "id":
            break
        ends = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(key).alias("n")).first()
        if k >= ends["n"]:                                    # among the NULLs, which come last
            df, k, n = df.filter(key.isNull()), k - ends["n"], n - ends["n"]
            continue
        lo, hi, n = ends["lo"], ends["hi"], ends["n"]
        df = df.filter(key.isNotNull())
        while n > sort_rows and lo < hi:
            width = (hi - lo) // REFINE_BINS + 1 if isinstance(lo, int) else (hi - lo) / REFINE_BINS
            # not exact for wide ranges, but never out of order, and lo and hi always part
            part = F.least(F.floor((key - F.lit(lo)) / F.lit(width)), F.lit(REFINE_BINS))
            parts = df.groupBy(part.alias("b")).agg(
                F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).collect()
            if len(parts) == 1:                               # a range beyond double precision
                break
            for r in sorted(parts, key=lambda r: -r["b"] if descending else r["b"]):
                if k < r["n"]:
                    break
                k -= r["n"]
            lo, hi, n = r["lo"], r["hi"], r["n"]
            df = df.filter((key >= F.lit(lo)) & (key <= F.lit(hi)))
    names = [f"_{i}" for i in range(len(spec))]
    keys = df.select(*[e.alias(n) for n, (_, e, _) in zip(names, spec)])
    order = [F.col(n).desc_nulls_last() if d else F.col(n).asc_nulls_last() for n, (_, _, d) in zip(names, spec)]
    row = keys.orderBy(*order).limit(k + 1).offset(k).first()
    return {c: v for (c, _, _), v in zip(spec, row)}


def page_info(df: DataFrame, page_no: int, size: int = C.DEFAULT_PAGE_SIZE) -> DataFrame:
    """V7: start, end, total, pages as one row (computed from one count)."""
    total_df = df.agg(F.count(F.lit(1)).alias("total_rows"))
    pages = F.greatest(F.lit(1), F.ceil(F.col("total_rows") / F.lit(size))).cast("bigint")
    pg = F.when(F.lit(page_no) > pages, F.lit(1)).when(F.lit(page_no) < 1, F.lit(1)) \
        .otherwise(F.lit(page_no)).cast("bigint")
    start = (pg - 1) * size
    return total_df.select(
        pg.alias("page"), F.lit(size).cast("bigint").alias("page_size"),
        (start + 1).alias("start_row"),
        F.least(start + size, F.col("total_rows")).alias("end_row"),
        F.col("total_rows"), pages.alias("total_pages"))


def display_projection(df: DataFrame) -> DataFrame:
    """V8: the nine display columns, renamed; Severity 2 and ML Rank Score 4 decimals (the rule of array libraries)."""
    out = []
    for src, label in C.DISPLAY_COLUMNS:
        if src not in df.columns:
            continue
        c = F.col(src)
        if src == "severity_raw":
            c = R.scaled(c, 2)
        elif src == "predicted_priority_score":
            c = R.scaled(c, 4)
        out.append(c.alias(label))
    if "position" in df.columns:
        out.append(F.col("position"))
    return df.select(*out)


def inspect(df: DataFrame, threat_id: str) -> DataFrame:
    """V9: point lookup in the *filtered* set; score NULL or 0 → 0 (4 decimals of the exact value).

    Over ``store.lookup`` it reads the id's bucket alone.
    """
    hit = df.filter(F.col("id") == threat_id).limit(1)
    return hit.select(
        "id", "title", "threat_type", "source", "severity_raw", "report_count", "predicted_priority",
        R.exact(F.coalesce(F.col("predicted_priority_score"), F.lit(0.0)), 4).alias("ml_rank_score"),
        "heuristic_label", "first_seen", "last_seen", "description",
        *[F.col(f"extra.{x}").alias(x) for x in ("vendor", "cwe", "reference_count",
                                                   "country_code", "isp")])


def metrics_summary(metrics: DataFrame) -> DataFrame:
    """S8: model name with '_' → ' ' in title case, accuracy × 100 to one decimal."""
    return metrics.select(
        F.initcap(F.regexp_replace(F.col("model"), "_", " ")).alias("model_name"),
        F.round(F.col("accuracy") * 100, 1).alias("accuracy_pct"))


# ---------------------------------------------------------------- keyset --
def cursor_of(row) -> dict:
    """Cursor (ranking-key values) of a row from a ranked page."""
    names = row.asDict()
    rank = C.SEVERITY_RANK.get(names.get("predicted_priority"), -1)
    score = "predicted_priority_score" if {"predicted_priority", "predicted_priority_score"} <= set(names) else "severity_raw"
    return {"_rank": rank, "_score": row[score], "batch_id": row["batch_id"], "seq": row["seq"], "id": row["id"]}


def _after(expr: Column, value, descending: bool) -> Column:
    """``expr`` strictly after ``value`` in one key's order (NULLs last)."""
    if value is None:
        return F.lit(False)                       # nothing sorts after a trailing NULL
    beyond = expr < F.lit(value) if descending else expr > F.lit(value)
    return beyond | expr.isNull()


def page_after(df: DataFrame, cursor: dict, size: int = C.DEFAULT_PAGE_SIZE,
               desc: bool = True) -> DataFrame:
    """Keyset paging: the ``size`` rows that follow ``cursor`` in the ranking.

    The same rows as ``page`` for the next page number, reached by a pushed-down
    lexicographic predicate plus a top-k — no global sort and no offset, so a
    deep page costs one scan however far down it is.
    """
    spec = rank_key_spec(df, desc)
    return df.filter(_beyond(spec, cursor)).orderBy(*rank_keys(df, desc)).limit(size)


def _beyond(spec: list[tuple[str, Column, bool]], cursor: dict, itself: bool = False) -> Column:
    """Rows after the cursor in the ranking, and with ``itself`` those level with it."""
    pred, level = None, F.lit(True)
    for name, expr, descending in spec:
        term = level & _after(expr, cursor[name], descending)
        pred = term if pred is None else pred | term
        level = level & expr.eqNullSafe(F.lit(cursor[name]))
    return pred | level if itself else pred


def read_metrics(spark, path: str) -> DataFrame | None:
    """S8 read: the metrics document, or None (with a message) when none was written."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        print(f"no metrics have been written to {path}")
        return None
    return metrics_summary(spark.read.json(path))
