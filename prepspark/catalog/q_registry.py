"""Registry, audit, report, search, split, reduction, IO and full-run queries."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..functions.types import is_numeric_type
from ..operators import audit as AU
from ..operators import merkle as MK
from ..operators import reduce as DR
from ..operators import registry as RG
from ..operators import report as RP
from ..operators import runs as RU
from ..operators import search as ML
from ..plans import prep as PL
from ..session import ensure_checkpoint_dir
from ..sources import io as IO
from ..sources.tables import load
from . import query
from .q_clean import _handle_union
from .sqlfacts import id_like_sql, with_facts
from .sqlgen import SCHEMAS, src, union

REGISTRY_TABLES = ["customer", "part", "lineitem", "orders", "supplier", "events", "documents"]


def _registry(spark, sf):
    # one small job pair per table; the tables are independent, so submit them concurrently
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=4) as pool:
        fps = list(pool.map(lambda t: (t, RG.fingerprint_row(load(spark, sf, t))), REGISTRY_TABLES))
    return RG.fingerprint_df(spark, fps)


def _fp_sql_rows(view, target=None):
    """SQL: one fingerprint row of ``view`` (stats only)."""
    cols = SCHEMAS[view]
    feats = [(c, k) for c, k in cols if c != target]
    nnum = sum(1 for _, k in feats if k == "num")
    ncat = len(feats) - nnum
    miss = " + ".join(f"(count(*) - count({c}))" for c, _ in cols)
    uniq = " + ".join(f"count(DISTINCT {c})" for c, _ in feats)
    ttype = "unknown" if not target else ("numeric" if dict(cols)[target] == "num" else "categorical")
    return (f"SELECT '{view}' AS dataset_id, count(*) AS num_rows, CAST({len(cols)} AS BIGINT) AS num_columns, "
            f"CAST({nnum} AS BIGINT) AS num_numeric_columns, CAST({ncat} AS BIGINT) AS num_categorical_columns, "
            f"CASE WHEN count(*) > 0 THEN round(({miss}) * 100.0 / (count(*) * {len(cols)}), 4) ELSE 0.0 END AS missing_percentage, "
            f"round(({uniq}) / {max(len(feats), 1)}.0, 4) AS avg_unique_values, '{ttype}' AS target_type FROM {view}")


def _fp_id_sql(r):
    return (f"'FP-' || upper(substr(sha256('{{\"avg_unique_values\": ' || CAST({r}.avg_unique_values AS VARCHAR) || "
            f"', \"missing_percentage\": ' || CAST({r}.missing_percentage AS VARCHAR) || "
            f"', \"num_categorical_columns\": ' || CAST({r}.num_categorical_columns AS VARCHAR) || "
            f"', \"num_columns\": ' || CAST({r}.num_columns AS VARCHAR) || "
            f"', \"num_numeric_columns\": ' || CAST({r}.num_numeric_columns AS VARCHAR) || "
            f"', \"num_rows\": ' || CAST({r}.num_rows AS VARCHAR) || "
            f"', \"target_type\": \"' || {r}.target_type || '\"}}'), 1, 12))")


@query("table_fingerprint", src("doc_quality") + "SELECT f.*, " + _fp_id_sql("f") + " AS fingerprint_id FROM ("
       + _fp_sql_rows("doc_quality", "quality").replace("FROM doc_quality", "FROM src").replace("'doc_quality' AS dataset_id, ", "") + ") f")
def table_fingerprint(spark, sf):
    fp = RG.fingerprint_row(load(spark, sf, "doc_quality"), "quality")
    return RG.fingerprint_df(spark, [("x", fp)]).drop("dataset_id")


def _sim_sql(cur_view, cur_target):
    reg = union([_fp_sql_rows(t) for t in REGISTRY_TABLES])
    cur = _fp_sql_rows(cur_view, cur_target).replace(f"FROM {cur_view}", "FROM src")
    return (src(cur_view) + f", reg AS ({reg}), cur AS ({cur})\n"
            "SELECT r.dataset_id, round(greatest(0.0, 1.0 - abs(c.num_columns - r.num_columns) / greatest(greatest(c.num_columns, 1), greatest(r.num_columns, 1), 1)) * 0.4 "
            "+ greatest(0.0, 1.0 - abs(c.num_numeric_columns / greatest(c.num_columns, 1) - r.num_numeric_columns / greatest(r.num_columns, 1))) * 0.35 "
            "+ greatest(0.0, 1.0 - abs(c.missing_percentage - r.missing_percentage) / 100.0) * 0.25, 4) AS similarity FROM reg r, cur c")


@query("fingerprint_similarity", _sim_sql("orders_dirty", "o_orderstatus"))
def fingerprint_similarity(spark, sf):
    fp = RG.fingerprint_row(load(spark, sf, "orders_dirty"), "o_orderstatus")
    return RG.score_registry(fp, _registry(spark, sf)).select("dataset_id", "similarity")


@query("top_similar", "SELECT dataset_id, similarity, similarity >= 0.75 AS found FROM (" +
       _sim_sql("orders_dirty", "o_orderstatus") + ") ORDER BY similarity DESC, dataset_id LIMIT 5")
def top_similar(spark, sf):
    fp = RG.fingerprint_row(load(spark, sf, "orders_dirty"), "o_orderstatus")
    return RG.top_similar(fp, _registry(spark, sf)).select("dataset_id", "similarity", "found")


@query("keep_latest", "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 200")
def keep_latest(spark, sf):
    ev = load(spark, sf, "events")
    return RG.keep_latest(ev, ["ts", "event_id"], 200)


def _hist_sql():
    reg = union([_fp_sql_rows(t).replace(f"'{t}' AS dataset_id", f"'{t}' AS dataset_id, {i} AS ts")
                 for i, t in enumerate(REGISTRY_TABLES)])
    return (src("orders_dirty") + f", reg AS ({reg}), cur AS (SELECT count(*) AS n FROM src)\n"
            "SELECT dataset_id, num_rows AS \"rows\", num_columns AS \"columns\", "
            "abs(num_rows - cur.n) + 10 * abs(num_columns - 6) AS distance FROM reg, cur ORDER BY distance, ts LIMIT 1")


@query("history_suggest", _hist_sql())
def history_suggest(spark, sf):
    reg = _registry(spark, sf)
    order = F.create_map(*[x for i, t in enumerate(REGISTRY_TABLES) for x in (F.lit(t), F.lit(i))])
    hist = reg.select("dataset_id", F.col("num_rows").alias("rows"), F.col("num_columns").alias("columns"),
                      F.lit("").alias("problem_type"), F.element_at(order, F.col("dataset_id")).alias("ts"))
    cur = load(spark, sf, "orders_dirty")
    stats = {"rows": cur.count(), "columns": len(cur.columns), "problem_type": "classification"}
    return RG.suggest_from_history(stats, hist).select("dataset_id", "rows", "columns", "distance")


# ---- audit -----------------------------------------------------------------------------

_LI = [c for c, _ in SCHEMAS["lineitem"]]


@query("table_digest", src("lineitem") + "SELECT count(*) AS \"rows\", CAST(coalesce(sum(CAST(('0x' || substr(md5(concat_ws(chr(1), "
       + ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(0))" for c in _LI)
       + ")), 1, 12)) AS BIGINT)), 0) AS DECIMAL(38,0)) AS digest FROM src")
def table_digest(spark, sf):
    return AU.table_digest(load(spark, sf, "lineitem"))


def _merkle_sql(view, columns, tail, levels=3):
    row = "concat_ws(chr(1), " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(0))" for c in columns) + ")"
    ctes = [f"l0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS i, h FROM (SELECT sha256({row}) AS h FROM src))"]
    for k in range(1, levels + 1):
        last = f"l{k - 1}"
        joined = "sha256(string_agg(h, '' ORDER BY i))"
        ctes.append(f"l{k} AS (SELECT i // 256 AS i, CASE WHEN (SELECT count(*) FROM {last}) = 1 THEN any_value(h) ELSE {joined} END AS h FROM {last} GROUP BY 1)")
    return src(view) + ", " + ",\n".join(ctes) + "\n" + tail


@query("table_merkle", _merkle_sql("lineitem", _LI, 'SELECT (SELECT count(*) FROM l0) AS "rows", h AS root FROM l3'))
def table_merkle(spark, sf):
    """AU1: rows and Merkle root of a table."""
    return MK.merkle_root(MK.merkle_tree(load(spark, sf, "lineitem")))


@query("merkle_proof", _merkle_sql("lineitem", _LI, """SELECT level::INT AS level, true AS joined FROM (VALUES (0), (1), (2), (3)) AS t(level)
WHERE level <= CASE WHEN (SELECT count(*) FROM l0) = 1 THEN 0 WHEN (SELECT count(*) FROM l1) = 1 THEN 1 WHEN (SELECT count(*) FROM l2) = 1 THEN 2 ELSE 3 END"""))
def merkle_proof(spark, sf):
    """AU1: the proof of the row with the least hash; each level's hashes join to the next level's."""
    tree = MK.merkle_tree(load(spark, sf, "lineitem"))
    steps = MK.proof(tree, tree.where("level = 0").agg(F.min("hash")).first()[0])
    above = steps.select((F.col("level") - 1).alias("level"), F.col("hash").alias("above"))
    joined = F.sha2(F.concat("before", "hash", "after"), 256) == F.col("above")
    return steps.join(above, "level", "left").select("level", F.when(F.col("above").isNull(), True).otherwise(joined).alias("joined"))


_PAYLOAD = "concat_ws('|', event_type, props, CAST(ts AS VARCHAR))"


_CHAIN_SQL = f"""WITH RECURSIVE e AS (
  SELECT CAST(user_id AS VARCHAR) AS g, event_id AS o, {_PAYLOAD} AS p,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
c(g, o, rn, prev_hash, current_hash) AS (
  SELECT g, o, rn, 'GENESIS', sha256(p || 'GENESIS') FROM e WHERE rn = 1
  UNION ALL
  SELECT e.g, e.o, e.rn, c.current_hash, sha256(e.p || c.current_hash) FROM e JOIN c ON e.g = c.g AND e.rn = c.rn + 1)
SELECT g AS user_id, o AS event_id, prev_hash, current_hash FROM c"""


@query("audit_chain", _CHAIN_SQL)
def audit_chain(spark, sf):
    ev = load(spark, sf, "events").withColumn(
        "payload", F.concat_ws("|", "event_type", "props", F.col("ts").cast("string")))
    return AU.chain(ev, "user_id", "event_id", "payload")


@query("stream_audit_chain", _CHAIN_SQL)
def stream_audit_chain(spark, sf):
    """AU2 on a stream: the same links, carried from micro-batch to micro-batch."""
    from ..streaming import apply as ST
    from ..streaming.chain import stream_chain

    sdf = ST.file_stream(spark, sf, "events.parquet", load(spark, sf, "events").schema)
    sdf = sdf.withColumn("payload", F.concat_ws("|", "event_type", "props", F.col("ts").cast("string")))
    out, ckpt = ST.stream_output_paths(ensure_checkpoint_dir(spark), f"chain-{uuid.uuid4().hex[:8]}")
    ST.run_available(stream_chain(sdf, "user_id", "event_id", "payload"), out, ckpt)
    return spark.read.parquet(out).where("accepted").drop("accepted")


@query("audit_latest", "SELECT * FROM events ORDER BY event_id DESC LIMIT 300")
def audit_latest(spark, sf):
    return AU.audit_latest(load(spark, sf, "events"), "event_id", 300)


@query("audit_count", "SELECT user_id, count(*) AS records FROM events GROUP BY user_id")
def audit_count(spark, sf):
    return AU.audit_count(load(spark, sf, "events"), "user_id")


@query("audit_record_at", "SELECT * FROM events WHERE user_id = 7 ORDER BY event_id LIMIT 1 OFFSET 3")
def audit_record_at(spark, sf):
    return AU.audit_record_at(load(spark, sf, "events"), "user_id", "event_id", 7, 3)


@query("decision_log")
def decision_log(spark, sf):
    df = load(spark, sf, "orders_dirty")
    res = PL.run_prep(df, "o_orderstatus", "classification", optimizer=False, key="o_orderkey")
    return res.decisions_df(spark)


# ---- reports -----------------------------------------------------------------------------

def _quality_sql(view, target, kind):
    cols = SCHEMAS[view]
    miss = " + ".join(f"(count(*) - count({c}))" for c, _ in cols)
    drop = (f"SELECT count(*) AS d FROM facts WHERE \"column\" <> '{target}' AND ({id_like_sql()} OR nunique_all <= 1 "
            f"OR (nunique / greatest(\"rows\", 1) >= 0.95 AND kind <> 'numeric'))")
    base = (with_facts(view) + f", rep AS ({_handle_union(view, target)}), dr AS ({drop}), "
            f"ms AS (SELECT round(({miss}) * 100.0 / greatest(count(*) * {len(cols)}, 1), 2) AS m, count(*) AS n FROM src), "
            "ot AS (SELECT coalesce(sum(outliers_found), 0) AS o FROM rep)\n")
    if kind == "quality":
        return base + ("SELECT round(greatest(0.0, least(100.0, 100.0 - m * 0.6 - CASE WHEN n > 0 THEN least(25.0, o / greatest(n, 1) * 100.0) ELSE 0.0 END "
                       "- least(20.0, d * 4.0))), 2) AS dataset_quality_score, m AS missing_pct, CAST(o AS BIGINT) AS outliers, d AS dropped FROM ms, ot, dr")
    return base + ("SELECT CASE WHEN m >= 25 OR o >= 20 OR d >= 4 THEN 'high' WHEN m >= 10 OR o >= 8 OR d >= 2 THEN 'medium' "
                   "ELSE 'low' END AS risk_level FROM ms, ot, dr")


def _quality_inputs(spark, sf, view, target):
    from ..operators import features as FE
    from ..operators import outliers as OU
    from ..operators import quality as QL
    df = load(spark, sf, view)
    ms = QL.issues_summary(df).select("missing_pct", "rows")
    o = OU.fit_outliers(df, target=target).total
    d = FE.column_drop_report(df, target).where("dropped").count()
    return ms.select("missing_pct", "rows", F.lit(o).cast("long").alias("outliers"), F.lit(d).cast("long").alias("dropped"))


@query("quality_score", _quality_sql("orders_dirty", "o_orderstatus", "quality"))
def quality_score(spark, sf):
    x = _quality_inputs(spark, sf, "orders_dirty", "o_orderstatus")
    return x.select(RP.quality_expr(F.col("missing_pct"), F.col("outliers"), F.col("dropped"), F.col("rows")).alias("dataset_quality_score"),
                    "missing_pct", "outliers", "dropped")


@query("risk_level", _quality_sql("customer_dirty", "c_mktsegment", "risk"))
def risk_level(spark, sf):
    x = _quality_inputs(spark, sf, "customer_dirty", "c_mktsegment")
    return x.select(RP.risk_expr(F.col("missing_pct"), F.col("outliers"), F.col("dropped")).alias("risk_level"))


# ---- search, split, reduction ----------------------------------------------------------------

@query("variant_search")
def variant_search(spark, sf):
    df = load(spark, sf, "doc_quality")
    res = ML.search(df, "quality", "classification", key="doc_id", trees=150)
    out = ML.results_df(spark, res)
    ok = sorted([r["score"] for r in res["results"] if r["status"] == "ok"], reverse=True)
    conf = RP.confidence(ok[0] if ok else None, ok[1] if len(ok) > 1 else None)
    return out.withColumn("confidence", F.lit(conf))


@query("train_test_split", "SELECT c_custkey, CAST(('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 20 AS is_test FROM customer")
def train_test_split(spark, sf):
    df = load(spark, sf, "customer").select("c_custkey")
    return ML.split(df, "c_custkey", test=0.2)


@query("train_test_split_stratified", """SELECT c_custkey, c_mktsegment,
  row_number() OVER (PARTITION BY coalesce(c_mktsegment, 'nan') ORDER BY ('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 12))::BIGINT, c_custkey)
    <= floor(count(*) OVER (PARTITION BY coalesce(c_mktsegment, 'nan')) * CAST(0.2 AS DOUBLE) + 0.5) AS is_test FROM customer""")
def train_test_split_stratified(spark, sf):
    df = load(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return ML.split(df, "c_custkey", "c_mktsegment", 0.2, stratify=True)


@query("pca_reduce")
def pca_reduce(spark, sf):
    df = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                            "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    plan = DR.fit_reducer(df, "l_returnflag", "classification", method="pca")
    return plan.transform(df, "l_returnflag")


_PCA_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _spectrum_sql(view, columns):
    """Traces of the first powers of the covariance matrix: they determine its eigenvalues."""
    cov = union([f"SELECT {i} AS i, {j} AS j, covar_samp({a} / 1.0, {b} / 1.0) AS v FROM src" for i, a in enumerate(columns) for j, b in enumerate(columns)])
    ctes, last = [f"p1 AS ({cov})"], "p1"
    for k in range(2, len(columns) + 1):
        ctes.append(f"p{k} AS (SELECT a.i, b.j, sum(a.v * b.v) AS v FROM {last} a JOIN p1 b ON a.j = b.i GROUP BY 1, 2)")
        last = f"p{k}"
    rows = [f"SELECT {k} AS power, round(ln(sum(v)), 6) AS log_trace FROM p{k} WHERE i = j" for k in range(1, len(columns) + 1)]
    return src(view) + ", " + ", ".join(ctes) + "\n" + union(rows)


@query("pca_spectrum", _spectrum_sql("lineitem", _PCA_COLS))
def pca_spectrum(spark, sf):
    """DR2: traces of powers of the covariance of the projected rows, all components kept."""
    df = load(spark, sf, "lineitem").select(*_PCA_COLS)
    done = DR.fit_pca(df, _PCA_COLS, variance=1.0).transform(df)
    own = [F.var_samp(c).alias(c) for c in done.columns]  # components are uncorrelated: their variances are the eigenvalues
    traces = [F.struct(F.lit(k).alias("power"), F.round(F.log(sum(F.col(c) ** k for c in done.columns)), 6).alias("log_trace"))
              for k in range(1, len(_PCA_COLS) + 1)]
    return done.agg(*own).select(F.inline(F.array(*traces)))


def _separation_sql(view, columns, target):
    """trace(pinv(Sw) Sb) of two columns, written out: the discriminant ratios' sum."""
    a, b = columns
    x, y = f"coalesce(CAST({a} AS DOUBLE), 0)", f"coalesce(CAST({b} AS DOUBLE), 0)"
    return src(view) + f""", t AS (SELECT CAST({target} AS VARCHAR) AS g, {x} AS x, {y} AS y FROM src),
c AS (SELECT g, count(*) AS n, avg(x) AS mx, avg(y) AS my FROM t WHERE g IS NOT NULL GROUP BY g), m AS (SELECT avg(x) AS mx, avg(y) AS my, count(*) AS n FROM t),
b AS (SELECT sum(c.n * (c.mx - m.mx) ** 2) AS xx, sum(c.n * (c.mx - m.mx) * (c.my - m.my)) AS xy, sum(c.n * (c.my - m.my) ** 2) AS yy FROM c, m),
w AS (SELECT var_pop(x) * count(*) - any_value(b.xx) AS xx, covar_pop(x, y) * count(*) - any_value(b.xy) AS xy, var_pop(y) * count(*) - any_value(b.yy) AS yy FROM t, b)
SELECT round((w.yy * b.xx - 2 * w.xy * b.xy + w.xx * b.yy) / (w.xx * w.yy - w.xy ** 2), 6) AS ratio FROM w, b"""


@query("lda_separation", _separation_sql("doc_quality", ["n_chars", "toxic"], "quality"))
def lda_separation(spark, sf):
    """DR3: between-class over within-class spread of the projected rows, summed over the components."""
    df = load(spark, sf, "doc_quality").select("n_chars", "toxic", "quality")
    plan = DR.fit_lda(df, ["n_chars", "toxic"], "quality")
    done = plan.transform(df, "quality")
    ratio = F.lit(0.0)
    for c in [c for c in done.columns if c != "quality"]:
        all_ = done.agg(F.avg(c).alias("m"), (F.var_pop(c) * F.count(F.lit(1))).alias("t")).first()
        groups = done.where("quality IS NOT NULL").groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.avg(c).alias("m"))
        between = groups.agg(F.sum(F.col("n") * (F.col("m") - all_["m"]) ** 2)).first()[0]
        ratio = ratio + F.lit(between / (all_["t"] - between))
    return spark.range(1).select(F.round(ratio, 6).alias("ratio"))


@query("lda_reduce")
def lda_reduce(spark, sf):
    df = load(spark, sf, "doc_quality")
    plan = DR.fit_reducer(df, "quality", "classification", method="lda")
    return plan.transform(df, "quality")


# ---- IO -------------------------------------------------------------------------------------

def _scratch(spark, name):
    return os.path.join(ensure_checkpoint_dir(spark), "io", f"{name}-{uuid.uuid4().hex[:8]}")


@query("target_last", src("orders_dirty") + "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate_text, o_orderpriority, o_orderstatus FROM src")
def target_last_q(spark, sf):
    return IO.target_last(load(spark, sf, "orders_dirty"), "o_orderstatus")


@query("version_roundtrip", src("orders_dirty") + "SELECT * FROM src")
def version_roundtrip(spark, sf):
    root = _scratch(spark, "versions")
    IO.save_version(load(spark, sf, "orders_dirty"), root, "run1", "After Missing")
    assert IO.list_versions(spark, root, "run1") == ["after_missing"]
    return IO.load_version(spark, root, "run1", "after missing")


@query("read_csv_infer", src("orders_dirty") + "SELECT * FROM src")
def read_csv_infer(spark, sf):
    path = _scratch(spark, "csv") + ".csv"
    (load(spark, sf, "orders_dirty").write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).option("nullValue", "").csv(path))
    return IO.read_table(spark, path)


@query("read_json", src("orders_dirty") + "SELECT * FROM src")
def read_json(spark, sf):
    path = _scratch(spark, "json") + ".json"
    load(spark, sf, "orders_dirty").write.json(path)
    df = IO.read_table(spark, path)
    return df.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate_text", "o_orderpriority")


# ---- full runs --------------------------------------------------------------------------------

@query("full_prep")
def full_prep(spark, sf):
    df = load(spark, sf, "orders_dirty")
    return PL.run_prep(df, "o_orderstatus", "classification", optimizer=False, key="o_orderkey").frame


@query("full_prep_search")
def full_prep_search(spark, sf):
    df = load(spark, sf, "doc_quality")
    res = PL.run_prep(df, "quality", "classification", optimizer=True, key="doc_id", trees=150)
    return res.reports["final"].drop("timestamp")


@query("basic_prep")
def basic_prep(spark, sf):
    df = load(spark, sf, "customer_dirty")
    return PL.run_basic_prep(df, "c_mktsegment", "classification", key="c_custkey").frame


@query("run_registry", src("customer_dirty") + """, n AS (SELECT count(*) AS rows FROM (SELECT DISTINCT * FROM src))
SELECT seq, n.rows AS dataset_rows, seq = 0 AS first_link, true AS intact FROM n, (VALUES (0::BIGINT), (1::BIGINT)) AS t(seq)""")
def run_registry(spark, sf):
    """AU2, PL2: the audit records that two runs leave in one store."""
    df = load(spark, sf, "customer_dirty")
    store = _scratch(spark, "store")
    for run in ("first", "second"):
        PL.run_basic_prep(df, "c_mktsegment", "classification", key="c_custkey", store=store, run_id=run)
    records = RU.read_runs(spark, store, "audit", RU.AUDIT)
    intact = all(RU.verify_audit(records))
    return records.select("seq", "dataset_rows", (F.col("prev_hash") == AU.GENESIS).alias("first_link"), F.lit(intact).alias("intact"))


__all__ = ["is_numeric_type"]


# ---- streaming extension ----------------------------------------------------------------------

@query("stream_scale_events", src("events") + "SELECT event_id, round((CAST(value AS DOUBLE) - (SELECT quantile_cont(value, 0.5) FROM src)) / "
       "(SELECT CASE WHEN quantile_cont(value, 0.75) - quantile_cont(value, 0.25) = 0 THEN 1.0 "
       "ELSE quantile_cont(value, 0.75) - quantile_cont(value, 0.25) END FROM src), 6) AS value FROM src")
def stream_scale_events(spark, sf):
    """X1: a robust scaler fitted in batch on events, applied to events read as a file stream."""
    from ..operators import scale as SC
    from ..streaming import apply as ST

    batch = load(spark, sf, "events").select("event_id", "value")
    plan = SC.fit_scaler(batch, columns=["value"], method="robust")
    sdf = ST.file_stream(spark, sf, "events.parquet", load(spark, sf, "events").schema).select("event_id", "value")
    out, ckpt = ST.stream_output_paths(ensure_checkpoint_dir(spark), f"scale-{uuid.uuid4().hex[:8]}")
    ST.run_available(ST.apply_plans(sdf, plan), out, ckpt)
    res = spark.read.parquet(out)
    return res.select("event_id", F.round("value", 6).alias("value"))
