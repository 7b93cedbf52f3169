"""Nightly batch runner.

``run_batches`` writes every registered extract to ``<out>/batch<n>/<name>/`` as CSV text
(header first, rows in the extract's order) and returns the run log as a DataFrame.

* An extract runs once.  Row types and error codes are counted by an ``Observation`` on
  the write itself, so neither the log nor the quality summary reads anything again, and
  a marker row is written only when the write has counted no rows.
* A write is committed as a whole: files go to ``<out>/_staging/<run>/``, and only a
  finished write is moved in place of the last run's files; then its log row is written.
  A driver that dies in between leaves the old files whole.  ``resume=<run>`` goes on
  with the same run and leaves out what its log says is done.
* A failing extract is logged and the run continues (the source runner's
  "continue on error").
* Output order, where the extract states one, is a range-partitioned sort, so no single
  task receives the whole file; extracts without an order are written without any shuffle.
* Pass ``persist_shared=True`` to write the derived SIS views once to the cluster's
  checkpoint folder and read them back (lineage cut, survives executor loss).
"""

from __future__ import annotations

import datetime as dt
import json
import time
import traceback
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rollbook.operators.ordering import with_ordinal
from rollbook.operators.quality import Rows, codes_in, codes_of
from rollbook.operators.render import header_line, render_lines
from rollbook.params import ExtractParams
from rollbook.plans.registry import Extract, all_extracts
from rollbook.session import ensure_checkpoint_dir
from rollbook.sources.catalog import Tables
from rollbook.sources.stored import store

TYPE_COLUMNS = ("row_type", "record_status", "recordType")
KINDS = ("CLEAN", "ERROR", "INFO")
LOG_SCHEMA = ("run string, extract string, batch int, start string, end string, seconds double, status string, rows long, "
              "clean_rows long, error_rows long, info_rows long, codes map<string,long>, message string")


# ---- lines ----------------------------------------------------------------------------

def line_expr(df: DataFrame, spec: Extract):
    """The rendered-line Column of ``df`` (same expression ``render_lines`` projects)."""
    return render_lines(df, spec.date_format, spec.ts_format, spec.quote, spec.date_formats, as_column=True, fields=spec.fields)


def order_keys(spec: Extract) -> list[tuple[str, F.Column, bool]]:
    """(name, expression over the extract's columns, descending) of the extract's order;
    ``expr:<sql>`` orders by an expression (O03)."""
    out = []
    for i, c in enumerate(spec.order):
        name = c.lstrip("-")
        e = F.expr(name[5:]) if name.startswith("expr:") else F.col(f"`{name}`")
        out.append((f"_k{i}", e, c.startswith("-")))
    return out


def _sorts(keys):
    return [F.col(k).desc_nulls_first() if desc else F.col(k).asc_nulls_last() for k, _, desc in keys]


def header_row(df: DataFrame, spec: Extract) -> DataFrame:
    return df.sparkSession.range(1).select(F.lit(header_line(df.columns, spec.quote)).alias("line"))


def ordered_lines(df: DataFrame, spec: Extract) -> DataFrame:
    """The file's lines: the header, then the rendered rows in the extract's order.  Columns: ``line``,
    ``_s`` (0 header / 1 row), ``_t`` (row type), ``_e`` (error codes).

    Ordered extracts are globally sorted (header first): a range shuffle over the order
    keys, so rows spread over all tasks and the header lands in the first file.  Extracts
    without a stated order (the source gives none) are not sorted at all: the header is
    the first child of a UNION ALL, so it is partition 0 and the first file, and the rows
    are written straight from their partitions with no shuffle."""
    keys = order_keys(spec)
    kind = next((c for c in TYPE_COLUMNS if c in df.columns), None)
    t = F.col(f"`{kind}`") if kind else F.lit(None).cast("string")
    e = F.col("validation_errors") if "validation_errors" in df.columns else F.lit(None).cast("string")
    body = df.select(line_expr(df, spec).alias("line"), *[k.alias(n) for n, k, _ in keys], F.lit(1).alias("_s"), t.alias("_t"), e.alias("_e"))
    none = [F.lit(None).cast(body.schema[n].dataType).alias(n) for n in [k for k, _, _ in keys] + ["_t", "_e"]]
    both = header_row(df, spec).select("line", F.lit(0).alias("_s"), *none).unionByName(body)
    if keys:
        both = both.orderBy(F.col("_s"), *_sorts(keys))
    return both.select("line", "_s", "_t", "_e")


def numbered_lines(df: DataFrame, spec: Extract) -> DataFrame:
    """``ordinal`` (W06; 0 is the header, U05), ``line``: a file's lines with their places in it.
    Rows that tie on the extract's order go by their text, so the numbers are the same in every run."""
    keys = order_keys(spec)
    body = store(df.select(line_expr(df, spec).alias("line"), *[e.alias(k) for k, e, _ in keys]), "lines")
    rows = with_ordinal(body, [*_sorts(keys), F.col("line").asc()]).select("ordinal", "line")
    return header_row(df, spec).select(F.lit(0).cast("long").alias("ordinal"), "line").unionByName(rows)


# ---- one extract -----------------------------------------------------------------------

def _metrics(codes: list[str]) -> list:
    """Aggregates over ``ordered_lines`` that count rows, row types and error codes.  Both lists are
    fixed by the extract's rules, whatever the data holds; codes outside them are counted together."""
    row = F.col("_s") == 1
    metrics = [F.count(F.when(row, 1)).alias("rows")]
    metrics += [F.count(F.when(row & (F.col("_t") == k), 1)).alias(f"{k.lower()}_rows") for k in KINDS]
    found = codes_in("_e")
    for i, code in enumerate(codes):
        metrics.append(F.sum(F.size(F.filter(found, lambda x: x == F.lit(code)))).alias(f"code_{i}"))
    known = F.array(*map(F.lit, codes)).cast("array<string>")
    return [*metrics, F.sum(F.size(F.array_except(found, known))).alias("other_codes")]


def _write(df: DataFrame, spec: Extract, path: str) -> dict:
    """Write one file; the counts come from the write, after the sort's shuffle (whose sampling
    of the bounds would count rows before it twice)."""
    obs = Observation(f"obs_{spec.name}_{uuid.uuid4().hex}")
    codes = codes_of(df)
    ordered_lines(df, spec).observe(obs, *_metrics(codes)).select("line").write.mode("overwrite").text(path)
    got = {k: int(v or 0) for k, v in obs.get.items()}
    counted = {c: got.pop(f"code_{i}", 0) for i, c in enumerate(codes)}
    if other := got.pop("other_codes", 0):
        counted["(other)"] = other
    return {**got, "codes": {c: n for c, n in counted.items() if n}}


def write_extract(out: DataFrame | Rows, spec: Extract, path: str) -> dict:
    """Write one extract and return its counts.  The marker of an empty extract is decided by the
    count of the write: nothing but the marker itself is written then."""
    if not isinstance(out, Rows):
        return _write(out, spec, path)
    if out.source is not None:
        return _write(out.resolved(), spec, path)
    counts = _write(out.rows, spec, path)
    return counts if counts["rows"] else _write(out.instead.select(*out.rows.columns), spec, path)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _commit(spark: SparkSession, staged: str, final: str) -> None:
    """Put finished files in place of the old ones; the old ones go only when the new are there."""
    fs, new = _fs(spark, staged)
    old, aside = _fs(spark, final)[1], _fs(spark, f"{staged}.old")[1]
    fs.mkdirs(old.getParent())
    replaced = fs.exists(old)
    if replaced and not fs.rename(old, aside):
        raise OSError(f"cannot move {final} aside")
    if not fs.rename(new, old):
        if replaced:
            fs.rename(aside, old)
        raise OSError(f"cannot move {staged} to {final}")
    if replaced:
        fs.delete(aside, True)


def _put(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    fs, target = _fs(spark, path)
    part = _fs(spark, f"{path}.part")[1]
    fs.mkdirs(target.getParent())
    stream = fs.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs.delete(target, False)
    fs.rename(part, target)


def run_one(spark: SparkSession, spec: Extract, tables: Tables, params: ExtractParams, out_dir: str, run: str) -> dict:
    start = dt.datetime.now(dt.timezone.utc)
    t0 = time.time()
    rec = {"run": run, "extract": spec.name, "batch": spec.batch, "start": start.isoformat(timespec="milliseconds")}
    spark.sparkContext.setJobDescription(f"extract {spec.name}")
    staged = f"{out_dir}/_staging/{run}/batch{spec.batch}/{spec.name}"
    try:
        rec.update(write_extract(spec.rows(tables, params), spec, staged))
        _commit(spark, staged, f"{out_dir}/batch{spec.batch}/{spec.name}")
        rec["status"] = "OK"
    except Exception as e:  # noqa: BLE001 — continue with the next extract, as the source runner does
        rec["status"] = "FAILED"
        rec["message"] = "".join(traceback.format_exception_only(type(e), e)).strip()
    rec["seconds"] = round(time.time() - t0, 3)
    rec["end"] = dt.datetime.now(dt.timezone.utc).isoformat(timespec="milliseconds")
    _put(spark, f"{out_dir}/_run_log/run={run}/{spec.name}.json", json.dumps(rec) + "\n")
    return rec


# ---- a run -----------------------------------------------------------------------------

def read_log(spark: SparkSession, out_dir: str, run: str) -> list[dict]:
    """Log rows of a run so far."""
    fs, folder = _fs(spark, f"{out_dir}/_run_log/run={run}")
    if not fs.exists(folder):
        return []
    rows = spark.read.schema(LOG_SCHEMA).json(f"{out_dir}/_run_log/run={run}/*.json").collect()
    return [r.asDict() for r in rows]


def quality_rows(log: list[dict]) -> list[tuple]:
    """C34 over a whole run: (extract, kind, item, n) from what the writes counted."""
    out = []
    for r in log:
        if r["status"] != "OK":
            continue
        kinds = {k: r.get(f"{k.lower()}_rows") or 0 for k in KINDS}
        rest = (r.get("rows") or 0) - sum(kinds.values())
        if rest:
            kinds["(none)"] = rest
        out += [(r["extract"], "row_type", k, n) for k, n in kinds.items() if n]
        out += [(r["extract"], "error_code", c, n) for c, n in (r.get("codes") or {}).items()]
    return out


def run_batches(spark: SparkSession, tables: Tables, out_dir: str, params: ExtractParams | None = None,
                batches=(1, 2, 3, 4), names=None, quality: bool = False, persist_shared: bool = False,
                parallelism: int = 1, share_scopes: bool = True, resume: str | None = None) -> DataFrame:
    """Write the selected extracts.  ``parallelism`` > 1 submits several
    extracts at once from driver threads: Spark runs their jobs concurrently,
    so many small extracts keep a large cluster busy instead of queueing.
    ``share_scopes`` computes intermediate frames that several extracts need
    (the distinct scoped enrolment keys) once per run and releases them at the end.
    ``quality`` writes the summary of row types and codes of all extracts of the run."""
    params = params or ExtractParams()
    run = resume or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]
    done = {r["extract"]: r for r in read_log(spark, out_dir, run) if r["status"] == "OK"} if resume else {}
    if persist_shared:
        tables = persist_tables(spark, tables)
    if share_scopes:
        tables = tables.with_sharing()
    specs = [s for s in sorted(all_extracts().values(), key=lambda s: (s.batch, s.name))
             if s.batch in batches and (not names or s.name in names)]
    todo = [s for s in specs if s.name not in done]
    if parallelism > 1:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            results = list(pool.map(lambda s: run_one(spark, s, tables, params, out_dir, run), todo))
    else:
        results = [run_one(spark, s, tables, params, out_dir, run) for s in todo]
    by_name = done | {r["extract"]: r for r in results}
    log = [by_name[s.name] for s in specs]
    if quality:
        spark.createDataFrame(quality_rows(log), "extract string, kind string, item string, n long") \
            .write.mode("overwrite").json(f"{out_dir}/_quality_summary")
    staging, folder = _fs(spark, f"{out_dir}/_staging/{run}")
    staging.delete(folder, True)
    if share_scopes:
        tables.release_shared()
    fields = [f.split()[0] for f in LOG_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(f) for f in fields) for r in log], LOG_SCHEMA)


def persist_tables(spark: SparkSession, tables: Tables, names=None) -> Tables:
    """Write frames of ``tables`` (all, or ``names``) once as parquet under the
    cluster's checkpoint folder and read them back: later extracts start from
    these files (no repeated derivation, lineage cut, executor loss safe)."""
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/rollbook-tables-{time.time_ns()}"
    frames = {n: tables[n] for n in tables.names()}
    for name in (names or tables.names()):
        path = f"{base}/{name}"
        tables[name].write.mode("overwrite").parquet(path)
        frames[name] = spark.read.parquet(path)
    return Tables(frames, spark)
