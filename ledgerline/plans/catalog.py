"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables (or data Spark derives from them) in
full. Dates and timestamps leave as ISO text so results compare exactly
with the DuckDB oracle in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import os
import uuid

from ledgerline.functions.codes import map_correction_status, map_status, normalise_state, state_index, state_tag
from ledgerline.functions.dates import bad_date, format_dmy, parse_dmy, parse_es_date
from ledgerline.functions.text import normalise_holder
from ledgerline.operators.registry import change_set
from ledgerline.operators import audit, corrections, diff, normalise, pages, slices
from ledgerline.plans import derived, jobs
from ledgerline.schemas import KEY, RAW_COLUMNS
from ledgerline.session import ensure_checkpoint_dir, written
from ledgerline.sinks import store, writers
from ledgerline.sources import snapshots

Query = Callable[[SparkSession, str], DataFrame]


def iso_text(df: DataFrame) -> DataFrame:
    """Dates/timestamps -> ISO text, so both engines print them alike."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out.append(F.col(f.name).cast("string").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# --- C1 over the derived registry R and snapshot N ---------------------------

def _sync(spark: SparkSession, sf_dir: str) -> jobs.SyncResult:
    reg = derived.registry_from_orders(spark, sf_dir)
    raw = derived.snapshot_batch(derived.snapshot_from_orders(spark, sf_dir))
    return jobs.sync_registry(raw, reg, derived.RUN_TS, persist=False)


def q_sync_report(spark, sf_dir):
    """Change report of one landed snapshot against the registry."""
    return _sync(spark, sf_dir).report.select("request_number", "changed", "columns_changed")


def q_upsert_registry(spark, sf_dir):
    """C1 / K1 + K2 + W4: the next registry state."""
    return iso_text(_sync(spark, sf_dir).registry)


def q_registry_changes(spark, sf_dir):
    """K1 + K2 as a change set: only the rows to insert or update."""
    reg = derived.registry_from_orders(spark, sf_dir)
    return iso_text(change_set(reg, _sync(spark, sf_dir).classified, "batch_no"))


#: Key-hash partitions of the registry store in the queries.
STORE_BUCKETS = 16


def q_store_commit(spark, sf_dir):
    """K1 + K2 into a partitioned store: the registry stored, the snapshot's changes committed, the next version read back."""
    base = scratch_dir(spark, "store")
    store.create_store(derived.registry_from_orders(spark, sf_dir), base, STORE_BUCKETS)
    version = store.commit_changes(_sync(spark, sf_dir).classified, base, 0)
    return iso_text(store.read_store(spark, base, version))


def q_change_totals(spark, sf_dir):
    """A1: inserts / updates / unchanged of the run."""
    return _sync(spark, sf_dir).totals


def q_diff_batch(spark, sf_dir):
    """J1 (+ J2, W4, F7, F8) on the single batch: every snapshot key classified."""
    reg = derived.registry_from_orders(spark, sf_dir)
    raw = derived.snapshot_batch(derived.snapshot_from_orders(spark, sf_dir))
    norm = normalise.normalise(raw, derived.RUN_TS)
    new = diff.first_per_key(norm, ["batch_no", "badger_country", KEY], "pos")
    return diff.diff_batch(new, reg).select(KEY, "badger_country", "change_type", "columns_changed")


def q_normalise_snapshot(spark, sf_dir):
    """P1 + P2 + F1-F6: the 13 normalised columns of every snapshot record."""
    raw = derived.snapshot_batch(derived.snapshot_from_orders(spark, sf_dir))
    return iso_text(normalise.normalise(raw, derived.RUN_TS).drop("batch_no", "pos"))


# --- version chain over events (V) ---------------------------------------------

V_KEYS = ["user_key"]
V_COMPARED = ["event_type", "band"]


def _v_classified(spark, sf_dir, bucket_size=7):
    v = derived.versions_from_events(spark, sf_dir)
    first = diff.first_per_key(v, V_KEYS + ["batch_no"], "pos")
    return diff.version_chain(first, None, "batch_no", key_cols=V_KEYS, compared=V_COMPARED,
                              bucket_size=bucket_size)


def q_first_per_key(spark, sf_dir):
    """First event per (user, day)."""
    v = derived.versions_from_events(spark, sf_dir)
    return diff.first_per_key(v, V_KEYS + ["batch_no"], "pos")


def q_version_chain(spark, sf_dir):
    """Each (user, day) version against the previous one (two-level lag, weekly buckets)."""
    return _v_classified(spark, sf_dir)


def q_batch_totals(spark, sf_dir):
    """A2: versions per (day, change type)."""
    return diff.change_totals(_v_classified(spark, sf_dir), group=["batch_no"])


def q_latest_state(spark, sf_dir):
    """Per user the values of the last changed version, insert and last-change day."""
    ch = diff.latest_changes(_v_classified(spark, sf_dir), "batch_no", V_KEYS, V_COMPARED)
    return ch.select("user_key", F.col("_ins.batch_no").alias("inserted_in"),
                     F.col("_last._changed_in").alias("changed_in"),
                     F.col("_last.event_type").alias("event_type"), F.col("_last.band").alias("band"))


# --- audit and corrections --------------------------------------------------------

def q_missing_keys(spark, sf_dir):
    """C2 (S4, S7, J3, O1): active registry keys absent from the snapshot's raw keys."""
    reg = derived.registry_from_orders(spark, sf_dir)
    seen = derived.snapshot_from_orders(spark, sf_dir).select(KEY)
    return audit.sorted_missing(jobs.audit_missing(seen, reg))


def q_orders_without_lines(spark, sf_dir):
    """J3 / U3 on the driver tables: order keys with no lineitem."""
    o = derived.load(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias(KEY))
    li = derived.load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias(KEY))
    return audit.missing_keys(o, li)


def corrections_from_orders(spark, sf_dir) -> DataFrame:
    """Lookup results for every COLOMBIA registry key of a 3-MEDIUM or
    4-NOT SPECIFIED order: 3-MEDIUM get 'Negada' then 'Cancelada' (later wins)
    when finished, 'Con oposicion' when open, 'Registrada' (unmapped) when
    pending; 4-NOT SPECIFIED get an error or a blank status."""
    b = derived.order_base(spark, sf_dir)
    med = b.filter(F.col("o_orderpriority") == "3-MEDIUM")
    first = med.select(KEY, F.when(F.col("o_orderstatus") == "F", "Negada")
                       .when(F.col("o_orderstatus") == "O", "Con oposicion").otherwise("Registrada")
                       .alias("extracted_status"),
                       F.lit(None).cast("string").alias("error"),
                       (F.col("o_orderkey") * 2).alias("pos"))
    second = med.filter(F.col("o_orderstatus") == "F").select(
        KEY, F.lit("Cancelada").alias("extracted_status"), F.lit(None).cast("string").alias("error"),
        (F.col("o_orderkey") * 2 + 1).alias("pos"))
    nspec = b.filter(F.col("o_orderpriority") == "4-NOT SPECIFIED").select(
        KEY, F.when(F.col("o_orderstatus") == "F", "").otherwise("Negada").alias("extracted_status"),
        F.when(F.col("o_orderstatus") == "O", "timeout").alias("error"),
        (F.col("o_orderkey") * 2).alias("pos"))
    return first.unionByName(second).unionByName(nspec)


def q_apply_corrections(spark, sf_dir):
    """C3 (P6, F5, W5, K3): the registry after status corrections."""
    reg = derived.registry_from_orders(spark, sf_dir)
    new_reg, _ = jobs.apply_corrections(corrections_from_orders(spark, sf_dir), reg, derived.RUN_TS)
    return iso_text(new_reg.select("id", KEY, "badger_country", "status", "updated_at"))


def q_unmapped_corrections(spark, sf_dir):
    """Q3: valid lookups whose status has no mapping."""
    _, unmapped = jobs.apply_corrections(corrections_from_orders(spark, sf_dir),
                                         derived.registry_from_orders(spark, sf_dir), derived.RUN_TS)
    return unmapped.select("request_number", "raw_value", "reason")


def q_correction_totals(spark, sf_dir):
    """Processed / valid / applied lookups."""
    return corrections.correction_totals(corrections_from_orders(spark, sf_dir))


# --- calendar slicing --------------------------------------------------------------

def _tagged_registry(spark, sf_dir):
    reg = derived.registry_from_orders(spark, sf_dir)
    return reg.withColumn("tag", F.when(audit.in_states("status"), F.lit("ACTIVE")).otherwise(F.lit("INACTIVE")))


def q_assign_slices(spark, sf_dir):
    """J7 + P10 + G5-G8: every registry row in the slice of its filing date and state."""
    plan = slices.full_plan(spark, derived.TODAY)
    out = slices.assign_slices(_tagged_registry(spark, sf_dir), "filing_date", plan, tag_col="tag")
    return out.select("id", "slice_id", "kind")


def q_assign_event_slices(spark, sf_dir):
    """J7 on week slices: each event's day in the open-ended recent weeks."""
    plan = slices.recent_plan(spark, derived.TODAY)
    ev = derived.load(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("d"))
    return slices.assign_slices(ev, "d", plan).select("event_id", "slice_id", "kind")


def _month_plan(spark):
    return slices.month_slices(spark, *slices.HISTORY_MONTHS, tag="ACTIVE").unionByName(
        slices.month_slices(spark, *slices.HISTORY_MONTHS, tag="INACTIVE"))


def _month_assigned(spark, sf_dir):
    return slices.assign_slices(_tagged_registry(spark, sf_dir), "filing_date", _month_plan(spark), tag_col="tag")


def q_slice_counts(spark, sf_dir):
    """A5: registry rows per month slice and tag, zero for empty slices."""
    return slices.slice_counts(_month_assigned(spark, sf_dir), _month_plan(spark))


OVERFLOW_CAP = 200


def q_slice_overflow(spark, sf_dir):
    """A4: per non-empty month slice its count and the cap flag (cap 200)."""
    return slices.slice_overflow(_month_assigned(spark, sf_dir), OVERFLOW_CAP)


def q_slice_kept_rows(spark, sf_dir):
    """A4: every assigned row, marked where its slice reaches the cap."""
    return slices.flag_overflow(_month_assigned(spark, sf_dir), OVERFLOW_CAP).select("id", "slice_id", "overflow")


def q_pending_slices(spark, sf_dir):
    """Month slices that no registry row landed in."""
    landed = _month_assigned(spark, sf_dir).select("slice_id")
    return slices.pending_slices(_month_plan(spark), landed).select("slice_id", "tag")


def q_class_slices(spark, sf_dir):
    """G7 + P11 + A5: active registry rows per class slice (classes 1..45)."""
    reg = _tagged_registry(spark, sf_dir).filter(F.col("tag") == "ACTIVE")
    counts = reg.groupBy(F.col("niza_class").alias("class_code")).agg(F.count(F.lit(1)).alias("n"))
    plan = slices.class_plan(spark)
    return (plan.join(counts, "class_code", "left")
            .select("slice_id", F.coalesce("n", F.lit(0)).alias("n")))


# --- portal pages ------------------------------------------------------------------

def q_parse_result_pages(spark, sf_dir):
    """X1 + X2 + F9-F11 + P9: raw records back out of the rendered result grids."""
    rows = pages.parse_result_rows(derived.listing_pages(spark, sf_dir))
    return rows.withColumn("holder", F.array_join("holder", " | "))


def q_detail_status(spark, sf_dir):
    """X4 + F17: looked-up status per request from detail pages."""
    return pages.detail_status(derived.detail_pages(spark, sf_dir))


def _all_pages(spark, sf_dir):
    return (derived.listing_pages(spark, sf_dir).select("page_id", "html")
            .unionByName(derived.detail_pages(spark, sf_dir).select("page_id", "html"))
            .unionByName(derived.no_result_pages(spark, sf_dir))
            .unionByName(derived.driver_pages(spark, sf_dir)))


PAGE_CAP = 150


def q_classify_pages(spark, sf_dir):
    """X5 + X3: page kind, result count and overflow flag (cap 150) of every page."""
    out = pages.result_count(pages.classify_page(_all_pages(spark, sf_dir)), cap=PAGE_CAP)
    return out.select("page_id", "kind", "result_count", "overflow")


def q_page_titles(spark, sf_dir):
    """F9 on the driver pages: cleaned title text."""
    return pages.page_title(derived.driver_pages(spark, sf_dir)).select("page_id", "title")


# --- landed files and JSON -----------------------------------------------------------

def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def q_json_roundtrip(spark, sf_dir):
    """K6 -> S1 + S2 + S3 + O2 -> P2: the snapshot landed as one JSON array per
    class slice, read back whole-file, parsed as VARIANT and normalised."""
    files = snapshots.read_numbered(spark, _landed_snapshot(spark, sf_dir), glob="*.txt", recursive=True)
    raw, _ = snapshots.snapshot_raw(files)
    return iso_text(normalise.normalise(raw, derived.RUN_TS).drop("batch_id", "batch_no", "pos"))


#: Slices of ``json_batches``: few enough to be above the cap of a document, the last one empty.
WIDE_SLICES = 5


def q_json_batches(spark, sf_dir):
    """K6 with a manifest -> S1 + O2 -> W1 -> P2: slices above the cap landed as several documents, an empty one as
    ``[]``, read back as one batch each. Every key lands twice in its slice, the later record with another status:
    the first one by original position counts."""
    snap = derived.snapshot_from_orders(spark, sf_dir)
    last = derived.load(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0] or 0
    slice_id = F.expr(f"concat('niza_', CAST(niza_class AS INT) % {WIDE_SLICES} + 1, '_1900_1900_ACTIVE')").alias("slice_id")
    first = snap.select(slice_id, F.col("o_orderkey").alias("pos"), *RAW_COLUMNS)
    again = snap.withColumn("status", F.lit("Negada")).select(slice_id, (F.col("o_orderkey") + last + 1).alias("pos"), *RAW_COLUMNS)
    landing = scratch_dir(spark, "landing")
    writers.write_snapshot_json(first.unionByName(again), landing,
                                slices=slices.class_plan(spark, WIDE_SLICES + 1).select("slice_id"))
    raw, _ = snapshots.snapshot_raw(snapshots.read_batches(spark, landing))
    kept = diff.first_per_key(raw, ["batch_no", KEY], "pos")
    return iso_text(normalise.normalise(kept, derived.RUN_TS).drop("batch_id", "batch_no", "pos"))


def _event_docs(spark, sf_dir):
    """JSON documents from events.props: clicks as a two-element array,
    errors behind an unclosed bracket (invalid), the rest one object."""
    e = derived.load(spark, sf_dir, "events").select("event_id", "event_type", "props")
    doc = (F.when(F.col("event_type") == "click", F.concat(F.lit("["), F.col("props"), F.lit(", "), F.col("props"), F.lit("]")))
           .when(F.col("event_type") == "error", F.concat(F.lit("["), F.col("props")))
           .otherwise(F.col("props")))
    return e.select("event_id", doc.alias("text"))


def q_json_records(spark, sf_dir):
    """Records of every well-formed document (array or single object)."""
    recs = snapshots.explode_records(_event_docs(spark, sf_dir))
    return recs.select("event_id", "pos", F.try_variant_get("rec", "$.k", "string").alias("k"))


def q_json_rejects(spark, sf_dir):
    """S3 / Q4: documents skipped whole, with the reason."""
    return snapshots.bad_documents(_event_docs(spark, sf_dir)).select("event_id", "reason")


# --- overlapping feeds through the whole chain -------------------------------------

def _feeds_sync(spark, sf_dir):
    reg = derived.registry_from_orders(spark, sf_dir)
    feeds = derived.feeds_from_snapshot(derived.snapshot_from_orders(spark, sf_dir))
    return jobs.sync_registry(feeds, reg, derived.RUN_TS, persist=False)


def q_union_feeds(spark, sf_dir):
    """U1 + U2 + U4 + W2: class feed then month feed over one registry; every version classified."""
    c = _feeds_sync(spark, sf_dir).classified
    return c.select("batch_no", KEY, "change_type", "columns_changed")


def q_feeds_registry(spark, sf_dir):
    """W3 + K1 + K2 after both feeds: stored values come from each key's last changed version."""
    return iso_text(_feeds_sync(spark, sf_dir).registry)


# --- scalar functions on driver columns ---------------------------------------------

def _date_texts(spark, sf_dir):
    o = derived.load(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    es = derived.es_date(F.col("d"))
    words = F.array(*[F.lit(w) for w in derived.MONTH_WORDS])
    mon = F.element_at(words, F.month("d"))
    v = F.col("o_orderkey") % 8
    raw = (F.when(v == 0, es).when(v == 1, F.upper(es))
           .when(v == 2, F.replace(es, F.lit("sept."), F.lit("sep.")))
           .when(v == 3, F.replace(es, F.lit(" "), F.lit("  ")))
           .when(v == 4, F.concat(F.lit(" "), es))
           .when(v == 5, F.concat_ws(" ", F.dayofmonth("d").cast("string"), mon,
                                     F.substring(F.year("d").cast("string"), 3, 2)))
           .when(v == 6, F.concat_ws(" ", F.lit("31"), mon, F.year("d").cast("string")))
           .otherwise(F.lit("")))
    return o.select("o_orderkey", raw.alias("raw"))


def q_date_parsing(spark, sf_dir):
    """F1 + F2 + Q2: portal date text variants -> DATE, and the bad-date flag."""
    t = _date_texts(spark, sf_dir)
    return t.select("o_orderkey", "raw", parse_es_date("raw").cast("string").alias("parsed"),
                    bad_date("raw").alias("bad"))


def q_holder_normalise(spark, sf_dir):
    """holder name lists -> one normalised text."""
    c = derived.load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    v = F.col("c_custkey") % 5
    names = (F.when(v == 0, F.array("c_name"))
             .when(v == 1, F.array(F.concat(F.lit("  "), F.lower("c_name"), F.lit("  x  "))))
             .when(v == 2, F.array(F.concat(F.col("c_name"), F.lit(";Co")), F.lit("b  c")))
             .when(v == 3, F.array().cast("array<string>"))
             .otherwise(F.array(F.lit(""), F.col("c_name"))))
    return c.select("c_custkey", normalise_holder(names).alias("holder"))


def q_status_mapping(spark, sf_dir):
    """F4 + F5 + J4: raw portal status words through both code tables."""
    o = derived.load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    w = derived.raw_status_word()
    v = F.col("o_orderkey") % 6
    raw = (F.when(v == 0, w).when(v == 1, F.upper(w)).when(v == 2, F.concat(F.lit(" "), w))
           .when(v == 3, F.lit("Con oposición")).when(v == 4, F.lit("Con oposicion"))
           .otherwise(F.lit("Publicada")))
    t = o.select("o_orderkey", raw.alias("raw"))
    return t.select("o_orderkey", "raw", map_status("raw").alias("mapped"),
                    map_correction_status("raw").alias("corrected"))


# --- streaming -------------------------------------------------------------------------

#: Staged records are committed at this share of the registry's rows.
COMMIT_SHARE = 1.0


def q_stream_sync(spark, sf_dir):
    """T1 + T2: both feeds landed as JSON files (class feed first), streamed
    oldest-first through foreachBatch into a partitioned store; the final
    registry version equals the batch result of ``feeds_registry``."""
    from ledgerline.streaming.sync import stream_sync

    root = scratch_dir(spark, "stream")
    snap = written(derived.snapshot_from_orders(spark, sf_dir))  # both feeds hold all of it
    feeds = derived.feeds_from_snapshot(snap)
    class_feed = feeds.filter(F.col("batch_no") < derived.FEED_MONTH_BASE)
    month_feed = feeds.filter(F.col("batch_no") >= derived.FEED_MONTH_BASE)
    for i, feed in enumerate((class_feed, month_feed), start=1):
        writers.write_snapshot_json(feed.withColumn("slice_id", F.col("batch_no").cast("string")),
                                    f"{root}/landing/feed={i}")
    store.create_store(derived.registry_from_orders(spark, sf_dir), f"{root}/registry", STORE_BUCKETS)
    version = stream_sync(spark, f"{root}/landing/feed=*/slice_id=*/document=*/*.txt", f"{root}/registry",
                          f"{root}/checkpoint", derived.RUN_TS, files_per_trigger=64, commit_share=COMMIT_SHARE)
    return iso_text(store.read_store(spark, f"{root}/registry", version))


# --- registry scans and sink round trips -------------------------------------------

def q_registry_scan(spark, sf_dir):
    """S5 + P8: the compared columns of the COLOMBIA registry rows."""
    from ledgerline.sources.registry import scan_registry
    return iso_text(scan_registry(derived.registry_from_orders(spark, sf_dir)))


def q_registry_lookup(spark, sf_dir):
    """S6 + J2: registry rows (COLOMBIA) whose key is in the snapshot, via a semi join."""
    from ledgerline.sources.registry import lookup_registry
    keys = derived.snapshot_from_orders(spark, sf_dir).select(KEY)
    return iso_text(lookup_registry(derived.registry_from_orders(spark, sf_dir), keys))


def q_active_keys(spark, sf_dir):
    """S7 + P7 + A3: distinct keys with an active status, any country."""
    from ledgerline.sources.registry import scan_active_keys
    return scan_active_keys(derived.registry_from_orders(spark, sf_dir))


def _landed_snapshot(spark, sf_dir) -> str:
    snap = derived.snapshot_from_orders(spark, sf_dir)
    landing = scratch_dir(spark, "landing")
    writers.write_snapshot_json(
        snap.select(F.concat(F.lit("niza_"), F.col("niza_class")).alias("slice_id"),
                    F.col("o_orderkey").alias("pos"), *RAW_COLUMNS), landing)
    return landing


def q_landed_raw_keys(spark, sf_dir):
    """Distinct raw keys over the landed snapshot files, before normalisation."""
    landing = _landed_snapshot(spark, sf_dir)
    return snapshots.raw_keys(snapshots.read_files(spark, landing, glob="*.txt", recursive=True))


def q_missing_roundtrip(spark, sf_dir):
    """K5 -> S8: the sorted missing-keys CSV written and read back."""
    out = scratch_dir(spark, "missing")
    writers.write_missing(q_missing_keys(spark, sf_dir), out)
    return snapshots.read_missing(spark, out)


def q_report_roundtrip(spark, sf_dir):
    """K4: the change report written as CSV (batch order, header) and read back."""
    out = scratch_dir(spark, "report")
    writers.write_change_report(_sync(spark, sf_dir).report, out)
    return (spark.read.option("header", True)
            .schema("request_number STRING, changed BOOLEAN, columns_changed STRING").csv(out))


def q_corrections_roundtrip(spark, sf_dir):
    """K7 -> S9 -> C3: lookups written as JSON arrays, read back in order and applied."""
    out = scratch_dir(spark, "corrections")
    writers.write_corrections(corrections_from_orders(spark, sf_dir), out)
    corr = snapshots.read_corrections(spark, out, glob="*.txt", recursive=True)
    new_reg, _ = jobs.apply_corrections(corr, derived.registry_from_orders(spark, sf_dir), derived.RUN_TS)
    return iso_text(new_reg.select("id", KEY, "badger_country", "status", "updated_at"))


def q_verify_and_correct(spark, sf_dir):
    """C4: missing active keys -> their detail pages (X4) -> corrections (C3) -> registry."""
    reg = derived.registry_from_orders(spark, sf_dir)
    seen = derived.snapshot_from_orders(spark, sf_dir).select(KEY)
    details = derived.detail_pages(spark, sf_dir).withColumn("pos", F.lit(0).cast("bigint"))
    _, new_reg, _ = jobs.verify_and_correct(
        seen, reg, details, derived.RUN_TS, read=lambda df: pages.detail_status(df, keep=["pos"]))
    return iso_text(new_reg.select("id", KEY, "badger_country", "status", "updated_at"))


# --- the remaining operators on driver tables --------------------------------------

def q_full_sync(spark, sf_dir):
    """Landed class files -> C1 -> C2 on their raw keys -> C3 with looked-up detail pages: the corrected registry."""
    reg = derived.registry_from_orders(spark, sf_dir)
    details = derived.detail_pages(spark, sf_dir).withColumn("pos", F.lit(0).cast("bigint"))
    lookups = pages.detail_status(details, keep=["pos"])
    out = jobs.full_sync(spark, _landed_snapshot(spark, sf_dir), reg, lookups, derived.RUN_TS,
                         glob="*.txt", recursive=True, persist=False)
    return iso_text(out.registry.select("id", KEY, "badger_country", "status", "updated_at"))


def _shifted_orders(spark, sf_dir):
    """Orders with a date moved over the whole calendar of the plans (some before, some after, some null) and a state tag."""
    o = derived.load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    return o.selectExpr("o_orderkey", "IF(o_orderkey % 31 = 0, NULL, "
                        "date_add(to_date(o_orderdate), CAST((o_orderkey % 211 - 170) * 210 AS INT))) AS d",
                        "IF(o_orderstatus = 'F', 'ACTIVE', 'INACTIVE') AS tag")


def q_full_plan_slices(spark, sf_dir):
    """G1-G6 + G8 + J7: every dated order in the year, month, week or day slice of its state."""
    plan = slices.full_plan(spark, derived.TODAY)
    return slices.assign_slices(_shifted_orders(spark, sf_dir), "d", plan, tag_col="tag").select("o_orderkey", "slice_id", "kind")


def q_outside_plan(spark, sf_dir):
    """Orders that no slice of the history plan (G5, active state) holds, those without a date included."""
    out = slices.outside_plan(_shifted_orders(spark, sf_dir), "d", slices.history_plan(spark), tag_col="tag")
    return iso_text(out.select("o_orderkey", "d", "tag"))


def q_year_block_counts(spark, sf_dir):
    """G1 + A5: orders per block of five years from 2 January 1900, cut at the end of 1998."""
    plan = slices.year_slices(spark, "1900-01-02", "1998-12-31", 5)
    return slices.slice_counts(slices.assign_slices(_shifted_orders(spark, sf_dir), "d", plan), plan)


def q_day_slice_counts(spark, sf_dir):
    """G4 + A5: events per day slice of one quarter, zero for days without."""
    plan = slices.day_slices(spark, "2024-01-01", "2024-03-31")
    ev = derived.load(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("d"))
    return slices.slice_counts(slices.assign_slices(ev, "d", plan), plan)


def q_date_range(spark, sf_dir):
    """P10: active registry rows filed in an inclusive range of dates."""
    out = slices.date_range_rows(_tagged_registry(spark, sf_dir), "filing_date", "1994-02-28", "1996-02-29", "tag", "ACTIVE")
    return iso_text(out.select("id", "filing_date", "tag"))


def q_class_filter(spark, sf_dir):
    """Registry rows of one class code."""
    return slices.class_rows(derived.registry_from_orders(spark, sf_dir), "niza_class", 35).select("id", "niza_class")


def q_state_tags(spark, sf_dir):
    """state words with padding, case and other values -> state, slice tag and form index."""
    raw = ("CASE o_orderkey % 7 WHEN 0 THEN 'active' WHEN 1 THEN '  Active ' WHEN 2 THEN 'INACTIVE' WHEN 3 THEN 'ACTIVE' "
           "WHEN 4 THEN '' WHEN 5 THEN 'activo' END")
    o = derived.load(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{raw} AS raw")
    return o.select("o_orderkey", normalise_state("raw").alias("state"), state_tag("raw").alias("tag"), state_index("raw").alias("form_index"))


def q_dmy_dates(spark, sf_dir):
    """F16: dates written as dd/MM/yyyy and read back; texts of other forms give no date."""
    o = derived.load(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    text = (F.when(F.col("o_orderkey") % 5 == 0, F.date_format("d", "yyyy-MM-dd"))
            .when(F.col("o_orderkey") % 5 == 1, F.concat(F.lit("31/02/"), F.year("d").cast("string"))).otherwise(format_dmy("d")))
    return iso_text(o.select("o_orderkey", text.alias("text"), parse_dmy(text).alias("parsed"), format_dmy("d", "_").alias("written")))


def q_missing_key_rejects(spark, sf_dir):
    """Q1: snapshot records that landed without a request number, as reject rows."""
    raw = derived.snapshot_batch(derived.snapshot_from_orders(spark, sf_dir)).withColumn(
        KEY, F.expr(f"CASE WHEN pos % 9 = 0 THEN NULL WHEN pos % 9 = 1 THEN '' ELSE {KEY} END"))
    return normalise.reject_missing_key(raw).select("source", "pos", "request_number", "column", "reason")


def q_common_columns(spark, sf_dir):
    """P3 + P4: customers and suppliers over the columns that both have, in the customers' order."""
    c = derived.load(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS request_number", "c_name AS name", "c_nationkey AS nation", "c_acctbal AS balance", "c_mktsegment AS segment")
    p = derived.load(spark, sf_dir, "supplier").selectExpr(
        "s_acctbal AS balance", "s_suppkey AS request_number", "s_nationkey AS nation", "s_name AS name")
    both = normalise.common_columns(c, p)
    return normalise.align_columns(c, ["absent", *both]).unionByName(normalise.align_columns(p, both))


QUERIES: dict[str, Query] = {
    "full_sync": q_full_sync,
    "full_plan_slices": q_full_plan_slices,
    "outside_plan": q_outside_plan,
    "year_block_counts": q_year_block_counts,
    "day_slice_counts": q_day_slice_counts,
    "date_range": q_date_range,
    "class_filter": q_class_filter,
    "state_tags": q_state_tags,
    "dmy_dates": q_dmy_dates,
    "missing_key_rejects": q_missing_key_rejects,
    "common_columns": q_common_columns,
    "sync_report": q_sync_report,
    "upsert_registry": q_upsert_registry,
    "registry_changes": q_registry_changes,
    "store_commit": q_store_commit,
    "change_totals": q_change_totals,
    "diff_batch": q_diff_batch,
    "normalise_snapshot": q_normalise_snapshot,
    "first_per_key": q_first_per_key,
    "version_chain": q_version_chain,
    "batch_totals": q_batch_totals,
    "latest_state": q_latest_state,
    "missing_keys": q_missing_keys,
    "orders_without_lines": q_orders_without_lines,
    "apply_corrections": q_apply_corrections,
    "unmapped_corrections": q_unmapped_corrections,
    "correction_totals": q_correction_totals,
    "assign_slices": q_assign_slices,
    "assign_event_slices": q_assign_event_slices,
    "slice_counts": q_slice_counts,
    "slice_overflow": q_slice_overflow,
    "slice_kept_rows": q_slice_kept_rows,
    "pending_slices": q_pending_slices,
    "class_slices": q_class_slices,
    "parse_result_pages": q_parse_result_pages,
    "detail_status": q_detail_status,
    "classify_pages": q_classify_pages,
    "page_titles": q_page_titles,
    "json_roundtrip": q_json_roundtrip,
    "json_batches": q_json_batches,
    "json_records": q_json_records,
    "json_rejects": q_json_rejects,
    "union_feeds": q_union_feeds,
    "feeds_registry": q_feeds_registry,
    "date_parsing": q_date_parsing,
    "holder_normalise": q_holder_normalise,
    "status_mapping": q_status_mapping,
    "stream_sync": q_stream_sync,
    "registry_scan": q_registry_scan,
    "registry_lookup": q_registry_lookup,
    "active_keys": q_active_keys,
    "landed_raw_keys": q_landed_raw_keys,
    "missing_roundtrip": q_missing_roundtrip,
    "report_roundtrip": q_report_roundtrip,
    "corrections_roundtrip": q_corrections_roundtrip,
    "verify_and_correct": q_verify_and_correct,
}

