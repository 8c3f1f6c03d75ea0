"""Registered queries: each takes (spark, data directory) and returns a DataFrame over the whole
input tables. Column names match the DuckDB forms in ``oracle.py``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import FILE_NAME_EXCLUDES, STAT_METRICS
from ..functions import text as tx
from ..functions.datetime import date_part, days_before, epoch_seconds_ntz_sql, hour_of, lenient_epoch, lenient_epoch_sql, time_part
from ..operators import caps as caps_op
from ..operators import checks, control, joblog, match_tables, membership, pivot, recon, thresholds
from ..session import ensure_checkpoint_dir
from ..sources import fixtures as fx
from ..sources import files, sinks, versions, zipped
from ..sources.tables import local_frame
from . import params as P


def _cdr(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ev = fx.load_events(spark, sf_dir)
    return fx.cdr_start(ev), fx.cdr_rnd(ev)


def _first_level_lag(spark: SparkSession) -> int:
    return checks.lag_for(fx.check_dictionary(spark, P.CHECK_LAGS), "CH01")


def recon_key_unmatched(spark, sf_dir):
    start, rnd = _cdr(spark, sf_dir)
    return checks.key_level_unmatched(start, rnd, P.AS_OF)


def recon_key_unmatched_concat(spark, sf_dir):
    start, rnd = _cdr(spark, sf_dir)
    return checks.key_level_unmatched(start, rnd, P.AS_OF, concat_key=True, reduce_by_imsi=True)


def recon_key_lag_sth(spark, sf_dir):
    """P3, P4 with lags that differ: the southern region's day is another one."""
    start, rnd = _cdr(spark, sf_dir)
    return checks.key_level_unmatched(start, rnd, P.AS_OF, lag_sth=P.LAG_STH)


def recon_key_glued_plain(spark, sf_dir):
    """J4 on keys that collide when glued: compared column by column."""
    start, rnd = _cdr(spark, sf_dir)
    return checks.key_level_unmatched(fx.with_moved_keys(start), rnd, P.AS_OF)


def recon_key_glued_concat(spark, sf_dir):
    """J7 on the same records: a key goes when its glued text is that of a matched key."""
    start, rnd = _cdr(spark, sf_dir)
    return checks.key_level_unmatched(fx.with_moved_keys(start), rnd, P.AS_OF, concat_key=True)


def recon_second_mixed_formats(spark, sf_dir):
    """source and counterpart write the same times in different forms."""
    start, rnd = _cdr(spark, sf_dir)
    return checks.first_level_unmatched(fx.mixed_times(start, "record_id"), fx.mixed_times(rnd, "timeKey"), P.AS_OF,
                                        days_back=_first_level_lag(spark))


def recon_second_unmatched(spark, sf_dir):
    start, rnd = _cdr(spark, sf_dir)
    return checks.first_level_unmatched(start, rnd, P.AS_OF, days_back=_first_level_lag(spark),
                                        caps=None)


def recon_second_capped(spark, sf_dir):
    start, rnd = _cdr(spark, sf_dir)
    rule = checks.CapRule(P.CAP_TRIGGER, P.CAP_PER_HOUR, P.CAP_TOTAL)
    return checks.first_level_unmatched(start, rnd, P.AS_OF, days_back=_first_level_lag(spark),
                                        caps=rule, reduce_by_imsi=True)


def recon_matched_pairs(spark, sf_dir):
    start, rnd = _cdr(spark, sf_dir)
    return checks.first_level_pairs(start, rnd, P.AS_OF, days_back=_first_level_lag(spark))


def recon_candidates_semi(spark, sf_dir):
    start, rnd = _cdr(spark, sf_dir)
    return checks.candidates_for_day(start, rnd, P.AS_OF, days_back=_first_level_lag(spark))


def recon_candidates_bitmap(spark, sf_dir):
    """P5 by a bitmap of hashed subscribers below the counterpart's shuffle."""
    start, rnd = _cdr(spark, sf_dir)
    day = days_before(P.AS_OF, _first_level_lag(spark))
    found = membership.bitmap_candidates(rnd.where(F.col("eventDate") == F.lit(day)),
                                         checks.first_level_source(start, day), "IMSI", P.BITMAP_BITS)
    return found.select("IMSI", "origToNumber", "service", "recType", "duration", "dateTime").distinct()


def recon_lag_lookup(spark, sf_dir):
    start, _ = _cdr(spark, sf_dir)
    return checks.lag_lookup(start, fx.check_dictionary(spark, P.CHECK_LAGS), P.AS_OF)


def _capped_day(spark, sf_dir, total):
    start, _ = _cdr(spark, sf_dir)
    day = days_before(P.AS_OF, _first_level_lag(spark))
    src = checks.first_level_source(start, day)
    cap = checks.first_level_cap(src, checks.CapRule(P.CAP_TRIGGER, P.CAP_PER_HOUR, total))
    return src, cap


def limit_by_hour(spark, sf_dir):
    start, _ = _cdr(spark, sf_dir)
    src = checks.first_level_source(start, days_before(P.AS_OF, _first_level_lag(spark)))
    # the cut leaves at most CAP_PER_HOUR rows an hour, which one task can rank
    first = caps_op.cut_by_hour(src, P.CAP_PER_HOUR).withColumn("hour", hour_of("eventDateTime"))
    ranked = caps_op.limit_by(first, ["hour"], ["eventDateTime", "record_id"], P.CAP_PER_HOUR, fanout=0,
                              keep_rank=True)
    return ranked.select("record_id", "eventDateTime", "hour",
                         F.col(caps_op.RANK_COL).cast("bigint").alias("hour_rank"))


def limit_total_capped(spark, sf_dir):
    src, cap = _capped_day(spark, sf_dir, P.CAP_TOTAL_TIGHT)
    return caps_op.apply_caps(src, cap).select("record_id", "eventDateTime", "duration")


def limit_by_subscriber(spark, sf_dir):
    """A5, W1 for groups of any number: the first records of every subscriber in every hour of day."""
    start, _ = _cdr(spark, sf_dir)
    records = start.select("record_id", "eventDateTime", "IMSI", hour_of("eventDateTime").alias("hour"))
    return thresholds.first_n(records, ["hour", "IMSI"], ["eventDateTime", "record_id"], P.CAP_PER_SUBSCRIBER)


def stat_daily(spark, sf_dir):
    start, _ = _cdr(spark, sf_dir)
    return fx.stat_daily(start)


def stat_pivot(spark, sf_dir):
    return pivot.stat_pivot(stat_daily(spark, sf_dir), P.PIVOT_METRICS)


def stat_pivot_full(spark, sf_dir):
    """A3 with all 30 metrics and the ordinal (F15, W7) in the result."""
    start, _ = _cdr(spark, sf_dir)
    return pivot.stat_pivot(fx.stat_full(start), STAT_METRICS, P.PIVOT_DAYS, ordinal_col="ordinal")


def stat_extract_ordered(spark, sf_dir):
    stat = stat_daily(spark, sf_dir).withColumnRenamed("cpName", "chName")
    return pivot.ordered_extract(stat, check_col="chName")


def _control_inputs(spark, sf_dir):
    start, _ = _cdr(spark, sf_dir)
    expected = control.expected_pairs(spark, P.CONTROL_REGIONS, P.CONTROL_CHECKS)
    return start, expected, F.col("iflag") == 1


def control_expected_minus_found(spark, sf_dir):
    start, expected, eligible = _control_inputs(spark, sf_dir)
    found = control.landed_pairs(start, P.CONTROL_AS_OF, region_col="MR", check_col="cpName",
                                 eligible=eligible)
    return control.expected_minus_found(expected, found, ["region", "check"])


def control_stale(spark, sf_dir):
    start, expected, eligible = _control_inputs(spark, sf_dir)
    return control.table_freshness(start, expected, P.CONTROL_AS_OF, region_col="MR",
                                   check_col="cpName", eligible=eligible)


def control_low_volume(spark, sf_dir):
    start, expected, eligible = _control_inputs(spark, sf_dir)
    return control.table_low_volume(start, expected, P.CONTROL_AS_OF, region_col="MR",
                                    check_col="cpName", eligible=eligible,
                                    max_rows=P.CONTROL_MAX_ROWS,
                                    exclude_checks=P.CONTROL_NOT_EMPTY_CHECKED)


def control_status(spark, sf_dir):
    passes = local_frame(spark, [(c,) for c in P.CONTROL_CHECKS], "check string")
    stale = control_stale(spark, sf_dir)
    low = control_low_volume(spark, sf_dir)
    a = control.status_rows(stale, passes, pass_col="check", item_col="region", kind="stale",
                            checked_at=P.CONTROL_CHECKED_AT)
    b = control.status_rows(low, passes, pass_col="check", item_col="region", kind="empty",
                            checked_at=P.CONTROL_CHECKED_AT)
    return a.unionByName(b)


def joblog_finished(spark, sf_dir):
    return joblog.finished_jobs(fx.job_log(fx.load_events(spark, sf_dir)), user=P.JOBLOG_USER)


def joblog_running(spark, sf_dir):
    return joblog.running_jobs(fx.running_jobs(fx.load_events(spark, sf_dir)))


def joblog_finished_ordered(spark, sf_dir):
    """L1 with its order (W6) as a position."""
    return joblog.with_report_position(joblog_finished(spark, sf_dir), "event_time", ["query", "read_rows", "result_rows"])


def joblog_running_ordered(spark, sf_dir):
    """L2 with its order (W6) as a position."""
    log = fx.running_jobs(fx.load_events(spark, sf_dir))
    ranked = joblog.with_report_position(joblog.running_jobs(log).join(log.select("query_id", "elapsed"), "query_id"),
                                         "elapsed", ["query_id"])
    return ranked.select("query_id", "pos")


def path_parts(spark, sf_dir):
    """P10, P11, F14, F17, F18 over the addresses of ``pages``."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    back = F.translate("url", "/", "\\")
    return pages.select(
        "page_id",
        tx.matches_any("url", ["BLOG", "example.com"]).alias("matches_any"),
        tx.eligible_file_name("url", ".html", [*FILE_NAME_EXCLUDES, "www"]).alias("eligible"),
        tx.last_component("url").alias("last_component"),
        tx.last_component(back).alias("last_component_back"),
        tx.parent_dir("url").alias("parent_dir"),
        tx.path_segment_matching("url", ["DE", "FR", "EN"]).alias("segment"),
        tx.strip_backslashes(back).alias("stripped"))


def latest_per_file(spark, sf_dir):
    """The newest eligible record file of each directory, over files described by records."""
    start, _ = _cdr(spark, sf_dir)
    facts = start.select(F.concat_ws("/", F.lit("/landing"), "MR", "cpName", F.concat(
        F.lit("f"), F.col("record_id").cast("string"), F.when(F.col("recType") == "1", "_SMS").otherwise(""),
        F.lit(".csv"))).alias("path"), F.concat_ws("/", F.lit("/landing"), "MR", "cpName").alias("dir"),
        F.col("eventDateTime").alias("mtime"))
    return control.latest_eligible_files(facts, suffix=".csv", excludes=FILE_NAME_EXCLUDES)


def scalar_datetime_cut(spark, sf_dir):
    start, _ = _cdr(spark, sf_dir)
    return start.select("record_id", "dateTime",
                        date_part("dateTime").alias("date"),
                        time_part("dateTime").alias("time"),
                        F.to_date(date_part("dateTime")).alias("day"),
                        hour_of("eventDateTime").alias("hour"),
                        F.date_sub("eventDate", P.DAYS_BACK).alias("day_minus_lag"),
                        lenient_epoch("dateTime").alias("epoch"),
                        F.concat(F.lit("!"), F.col("inputFileName")).alias("marked_file"))


def _scratch(spark: SparkSession, kind: str) -> str:
    """A fresh folder under the shared checkpoint folder the session names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"


def sink_partitioned_roundtrip(spark, sf_dir):
    """The first-level result written twice by (eventDate, cpName) slice replacement and read
    back; a rerun must not duplicate it."""
    path = _scratch(spark, "results")
    for _ in range(2):
        sinks.write_partitions(recon_second_unmatched(spark, sf_dir), path, ("eventDate", "cpName"))
    return spark.read.parquet(path)


def _read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Text columns of an export. The statistics are ASCII, which windows-1251 shares with ISO 8859-1; reading that
    needs no legacy switch in the session."""
    return spark.read.options(sep=";", header=True, encoding="iso-8859-1", quote='"').csv(path)


def sink_csv_roundtrip(spark, sf_dir):
    """The statistics pivot exported as the daily CSV (``;``, quoted, header, windows-1251,
    dated folder) and read back as text columns."""
    out = sinks.export_csv(stat_pivot(spark, sf_dir), _scratch(spark, "exports"),
                           "pivot-statistics", P.AS_OF)
    return _read_csv(spark, out)


def sink_partitioned_empty_rerun(spark, sf_dir):
    """A re-check that finds nothing leaves nothing of the old slice, and other slices alone."""
    path = _scratch(spark, "results")
    result = recon_second_unmatched(spark, sf_dir)
    kept = result.withColumn("eventDate", F.date_sub("eventDate", 1))
    sinks.write_partitions(result.unionByName(kept), path)
    day = days_before(P.AS_OF, _first_level_lag(spark))
    sinks.replace_slices(result.where(F.lit(False)), path, [{"eventDate": day, "cpName": "CH01"}])
    return spark.read.schema(result.schema).parquet(path)


def sink_gzip_roundtrip(spark, sf_dir):
    """The statistics as compressed CSV, read back with the date that its folder name carries."""
    base = _scratch(spark, "exports")
    sinks.export_csv(stat_daily(spark, sf_dir), base, "statistics", P.AS_OF, compression="gzip")
    return _read_csv(spark, f"{base}/statistics")


def sink_zip_roundtrip(spark, sf_dir):
    """The statistics as zipped CSV parts, written twice, and read back."""
    base = _scratch(spark, "exports")
    for _ in range(2):
        out = zipped.export_zip(stat_daily(spark, sf_dir), base, "statistics", P.AS_OF)
    return zipped.read_zip(spark, out)


def sink_versioned_rerun(spark, sf_dir):
    """S5 in one step: two days and a check whose name needs escaping are written, one day is rerun with half its records,
    the odd check with none; what the newest manifest names is left."""
    path, result = _scratch(spark, "versions"), recon_second_unmatched(spark, sf_dir)
    odd = result.withColumn("cpName", F.lit("CH:0/1%"))
    versions.replace(result.union(result.withColumn("eventDate", F.date_sub("eventDate", 1)).select(result.columns)).union(odd.select(result.columns)), path)
    versions.replace(result.where("record_id % 2 = 0"), path,
                     [{"eventDate": days_before(P.AS_OF, _first_level_lag(spark)), "cpName": "CH:0/1%"}])
    return versions.read(spark, path, result.schema)


def _match_tables(spark: SparkSession, tol: recon.Tolerance, time: str, left_carry, right_carry=()) -> match_tables.MatchTables:
    return match_tables.MatchTables(f"match_{uuid.uuid4().hex}", _scratch(spark, "match"), tol, time, time, left_carry, right_carry,
                                    buckets=P.MATCH_BUCKETS)


def recon_key_bucketed(spark, sf_dir):
    """J2, J4 over match tables of all days: the key-level check without a shuffle for its match."""
    start, rnd = _cdr(spark, sf_dir)
    tables = _match_tables(spark, recon.HOUR_SHIFT, "timeKey", ("MR", "cpName", "iflag"), ("macroregion",))
    tables.write_left(start)
    tables.write_right(rnd)
    return match_tables.key_level_unmatched(start, tables, P.AS_OF)


def recon_second_bucketed(spark, sf_dir):
    """J1, J3 over match tables of all days, times parsed once, when they are written."""
    start, rnd = _cdr(spark, sf_dir)
    tables = _match_tables(spark, recon.SAME_SECOND, lenient_epoch_sql("dateTime"), ("dateTime", "cpName", "iflag"))
    tables.write_left(start)
    tables.write_right(rnd)
    return match_tables.first_level_unmatched(start, tables, P.AS_OF, days_back=_first_level_lag(spark))


def scalar_lenient_forms(spark, sf_dir):
    """the time of every event in twelve forms, read back. Forms 10 and 11 are none."""
    events = fx.load_events(spark, sf_dir)
    t = "date_trunc('SECOND', ts)"

    def text(form: str, shift: int = 0) -> str:
        return f"date_format(timestampadd(SECOND, {shift}, {t}), '{form}')"

    forms = [text("yyyy-MM-dd HH:mm:ss"), text("yyyy-MM-dd\\'T\\'HH:mm:ss"), text("yyyy-MM-dd HH:mm"),
             text("dd.MM.yyyy HH:mm:ss"), f"cast({epoch_seconds_ntz_sql('ts')} AS string)",
             f"concat({text('yyyy-MM-dd HH:mm:ss')}, 'Z')", f"concat({text('yyyy-MM-dd HH:mm:ss', 10800)}, '+03:00')",
             text("dd MMM yyyy HH:mm:ss"), f"concat({text('yyyy-MM-dd HH:mm:ss')}, '.250')", text("dd-MMM-yyyy HH:mm:ss"),
             "concat('at ', cast(event_id AS string))", text("yyyy/MM/dd HH:mm:ss")]
    cases = " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(forms))
    return events.select("event_id", F.expr(f"CASE event_id % 12 {cases} END").alias("text")).select(
        "event_id", lenient_epoch("text").alias("epoch"))


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """A tree of landed files, one a page, written by tasks into the shared folder; its root."""
    root = _scratch(spark, "landed")
    fx.write_landed(fx.landed_pages(spark, sf_dir, P.AS_OF), root)
    return files._norm(root)


def _below(root: str, col: str):
    return F.expr(f"substring({col}, {len(root) + 2})")


def landed_facts(spark, sf_dir):
    """Facts and lines of every landed file, the lines in byte ranges."""
    root = _landed(spark, sf_dir)
    facts, _ = files.list_tree(spark, root)
    lines = files.line_counts(facts)
    return facts.join(lines, "path").select(
        _below(root, "path").alias("path"), "name", "length", F.unix_seconds("mtime").alias("seconds"), "lines")


def _landed_reports(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame, DataFrame]:
    root = _landed(spark, sf_dir)
    facts, dirs = files.list_tree(spark, root)
    channels = dirs.where(F.col("name").isin(P.LANDED_CHANNELS)).select(
        F.lit("daily").alias("pass"), "dir", F.col("name").alias("channel"))
    return (root, *control.file_reports(facts, channels, P.AS_OF, suffix=".csv", excludes=FILE_NAME_EXCLUDES,
                                        not_empty_checked=P.LANDED_NOT_EMPTY_CHECKED))


def landed_stale(spark, sf_dir):
    """Channel directories whose newest file is not of the run day, or that have none."""
    root, stale, _ = _landed_reports(spark, sf_dir)
    return stale.select("pass", _below(root, "dir").alias("dir"), "status")


def landed_empty(spark, sf_dir):
    """Fresh newest files with a header at most; no file is read beyond its second line's block."""
    root, _, empty = _landed_reports(spark, sf_dir)
    return empty.select("pass", _below(root, "dir").alias("dir"), "lines")


def landed_expected_minus_found(spark, sf_dir):
    """Expected region x channel pairs without a file since the run day's midnight."""
    return control.expected_minus_found_files(
        spark, _landed(spark, sf_dir), P.AS_OF, regions=P.LANDED_REGIONS, channels=P.LANDED_CHANNELS).select("region", "channel")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "recon_key_unmatched": recon_key_unmatched,
    "recon_key_unmatched_concat": recon_key_unmatched_concat,
    "recon_second_unmatched": recon_second_unmatched,
    "recon_second_capped": recon_second_capped,
    "recon_matched_pairs": recon_matched_pairs,
    "recon_candidates_semi": recon_candidates_semi,
    "recon_candidates_bitmap": recon_candidates_bitmap,
    "recon_lag_lookup": recon_lag_lookup,
    "limit_by_hour": limit_by_hour,
    "limit_total_capped": limit_total_capped,
    "limit_by_subscriber": limit_by_subscriber,
    "stat_daily": stat_daily,
    "stat_pivot": stat_pivot,
    "stat_extract_ordered": stat_extract_ordered,
    "control_expected_minus_found": control_expected_minus_found,
    "control_stale": control_stale,
    "control_low_volume": control_low_volume,
    "control_status": control_status,
    "joblog_finished": joblog_finished,
    "joblog_running": joblog_running,
    "scalar_datetime_cut": scalar_datetime_cut,
    "sink_partitioned_roundtrip": sink_partitioned_roundtrip,
    "sink_csv_roundtrip": sink_csv_roundtrip,
    "recon_key_lag_sth": recon_key_lag_sth,
    "recon_key_glued_plain": recon_key_glued_plain,
    "recon_key_glued_concat": recon_key_glued_concat,
    "recon_second_mixed_formats": recon_second_mixed_formats,
    "stat_pivot_full": stat_pivot_full,
    "joblog_finished_ordered": joblog_finished_ordered,
    "joblog_running_ordered": joblog_running_ordered,
    "path_parts": path_parts,
    "latest_per_file": latest_per_file,
    "sink_partitioned_empty_rerun": sink_partitioned_empty_rerun,
    "sink_gzip_roundtrip": sink_gzip_roundtrip,
    "sink_versioned_rerun": sink_versioned_rerun,
    "sink_zip_roundtrip": sink_zip_roundtrip,
    "recon_key_bucketed": recon_key_bucketed,
    "recon_second_bucketed": recon_second_bucketed,
    "scalar_lenient_forms": scalar_lenient_forms,
    "landed_facts": landed_facts,
    "landed_stale": landed_stale,
    "landed_empty": landed_empty,
    "landed_expected_minus_found": landed_expected_minus_found,
}
