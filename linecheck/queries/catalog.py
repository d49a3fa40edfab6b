"""One query per operator, each over the whole tables of a folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linecheck import functions as fn
from linecheck import schemas as S
from linecheck.operators import check as checks
from linecheck.operators import increments, keyed, ranks, report, stacking, timeline
from linecheck.operators.measured import written
from linecheck.operators.prepare import listed_models, prepare, typed_lines
from linecheck.operators.template import missing_templates, template_positions, template_sizes
from linecheck.plans import classify, inspection
from linecheck.queries import inputs
from linecheck.session import fresh_path
from linecheck.sources import files, tables, versions
from linecheck.sources.keyed_files import KeyedFiles
from linecheck.sources.versions import VersionedTable
from linecheck.streaming import inspect, keyed_state

Query = Callable[[SparkSession, str], DataFrame]

# Small enough that slots and cuts of crowded ones come into play on the given tables,
# and with NARROW also samples that skip the window.
IN_SLOTS = {"slot": "year", "limit": 100}
NARROW = {"slot": "month", "limit": 12}

# Times at which the readings of the streamed query are cut into arrivals.
ARRIVALS = ("1997-07-01 00:00:00", "1999-07-01 00:00:00")
# The line number whose readings arrive one part later where arrivals are to overlap.
LATE_LINE = 4


def scan_since_mark(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.scan_lines(inputs.readings(spark, folder), F.col("datetime") > F.lit(inputs.MARK))
    return rows.select("linenmb", "equipmentid", "mcid", "datetime")


def keyed_scan(spark: SparkSession, folder: str) -> DataFrame:
    return tables.scan(inputs.table(spark, folder, "customer"), "c_acctbal < 0 and c_mktsegment = 'BUILDING'")


def named_view(spark: SparkSession, folder: str) -> DataFrame:
    tables.register_view(inputs.table(spark, folder, "customer"), "linecheck_customer")
    return tables.read_table(spark, "linecheck_customer", "c_acctbal > 9000")


def new_mark(spark: SparkSession, folder: str) -> DataFrame:
    return increments.new_mark(inputs.readings(spark, folder))


def clean_coordinates(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.table(spark, folder, "lineitem").select(
        F.col("l_linenumber").alias("linenmb"),
        F.col("l_orderkey").cast("string").alias("equipmentid"),
        F.concat_ws("#", F.col("l_linestatus"), F.col("l_partkey").cast("string")).alias("mcid"),
        F.col("l_shipdate").alias("datetime"),
        F.col("l_returnflag").alias("leadx"),
        F.col("l_quantity").cast("string").alias("leady"),
        F.concat("l_linestatus", F.col("l_tax").cast("string")).alias("padx"),
        F.col("l_discount").cast("string").alias("pady"),
    )
    return typed_lines(rows)


def model_keys(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.lines(spark, folder).groupBy("mcid", "model_key").agg(F.count("*").alias("n_rows"))


def listed_lines(spark: SparkSession, folder: str) -> DataFrame:
    models = listed_models(inputs.model_list(spark, folder))
    rows = inputs.lines(spark, folder).join(models, "model_key", "left_semi")
    return rows.groupBy("model_key").agg(F.count("*").alias("n_rows"))


def segment_lines(spark: SparkSession, folder: str) -> DataFrame:
    return prepare(inputs.readings(spark, folder)).drop("model_key")


def segment_lines_in_slots(spark: SparkSession, folder: str) -> DataFrame:
    return prepare(inputs.readings(spark, folder), **IN_SLOTS).drop("model_key")


def _events(spark: SparkSession, folder: str, **options) -> DataFrame:
    rows = inputs.table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type")
    marker = F.col("event_type") == "signup"
    return timeline.segment(rows, ["user_id"], "ts", marker, start="started", **options)


def segment_events(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder)


def segment_events_in_slots(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder, slot="day", limit=4)


def sample_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return checks.sample_sizes(inputs.lines(spark, folder))


def sample_sizes_in_slots(spark: SparkSession, folder: str) -> DataFrame:
    return checks.sample_sizes(inputs.lines(spark, folder), **NARROW)


def template_lines(spark: SparkSession, folder: str) -> DataFrame:
    return template_positions(inputs.templates(spark, folder))


def template_counts(spark: SparkSession, folder: str) -> DataFrame:
    return template_sizes(inputs.templates(spark, folder))


def line_steps(spark: SparkSession, folder: str) -> DataFrame:
    return checks.sample_steps(inputs.lines(spark, folder))


def line_steps_in_slots(spark: SparkSession, folder: str) -> DataFrame:
    return checks.sample_steps(inputs.lines(spark, folder), **NARROW)


def line_offsets(spark: SparkSession, folder: str) -> DataFrame:
    rows = checks.full_samples(inputs.lines(spark, folder), inputs.templates(spark, folder))
    return rows.select(*checks.SAMPLE, "pos", "lead_offset", "pad_offset", F.col("bad").cast("int").alias("bad"))


def sample_codes(spark: SparkSession, folder: str) -> DataFrame:
    return checks.sample_codes(inputs.lines(spark, folder), inputs.templates(spark, folder))


def sample_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return checks.check(inputs.lines(spark, folder), inputs.templates(spark, folder))


def sample_verdicts_in_slots(spark: SparkSession, folder: str) -> DataFrame:
    return checks.check(inputs.lines(spark, folder), inputs.templates(spark, folder), **IN_SLOTS)


def models_without_template(spark: SparkSession, folder: str) -> DataFrame:
    return missing_templates(inputs.lines(spark, folder).select("model_key"), inputs.templates(spark, folder))


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    return report.alerts(sample_verdicts(spark, folder), inputs.equipment(spark, folder))


def alert_lines(spark: SparkSession, folder: str) -> DataFrame:
    return report.report_lines(alerts(spark, folder))


def first_alerts(spark: SparkSession, folder: str) -> DataFrame:
    box, model, _, time, *_ = S.ALERT_COLUMNS
    return report.first_rows(alerts(spark, folder), [time, box, model], 128)


def quality_summary(spark: SparkSession, folder: str) -> DataFrame:
    return report.quality_summary(sample_verdicts(spark, folder))


def stacked_parties(spark: SparkSession, folder: str) -> DataFrame:
    customers = inputs.table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    suppliers = inputs.table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return stacking.stack([customers, suppliers]).toDF("party", "name", "balance")


def tagged_parts(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.table(spark, folder, "embeddings").select("vec_id", "label")
    kept, held = classify.hold_out(rows, "vec_id", 0.25, seed=7)
    return stacking.stack_tagged({"train": kept, "test": held})


def keyed_insert(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.insert(
        inputs.table(spark, folder, "customer"), inputs.new_customers(spark, folder), ["c_custkey"]
    )


def keyed_upsert(spark: SparkSession, folder: str) -> DataFrame:
    rows = stacking.stack_by_name([inputs.changed_customers(spark, folder), inputs.new_customers(spark, folder)])
    return keyed.upsert(inputs.table(spark, folder, "customer"), rows, ["c_custkey"])


def keyed_update(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.changed_customers(spark, folder).select("c_custkey", "c_acctbal")
    return keyed.update(inputs.table(spark, folder, "customer"), rows, ["c_custkey"])


def results_once(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts appended by three runs: one is repeated, and two overlap, of which one is repeated too."""
    table = VersionedTable(spark, fresh_path(spark, "results"))
    verdicts = written(sample_verdicts(spark, folder), "verdicts")
    table.create(verdicts.schema)
    part = F.coalesce(sum((F.col("datetime") >= time).cast("int") for time in ARRIVALS), F.lit(0))
    first, second, third = (verdicts.where(part == n) for n in range(3))
    for _ in range(2):
        table.append(first, run="first")

    # The second run has written its files when the third commits, so it has to look again.
    properties = table.properties()
    seen = table.version()
    late = table.note(table.described(table.write(second), properties), properties)
    table.append(third, run="third")
    if not table.publish(seen, [late], run="second"):
        table.commit(lambda _: [late], run="second")
    table.append(second, run="second")
    return table.read()


def _customer_files(spark: SparkSession, folder: str) -> tuple[KeyedFiles, DataFrame]:
    """The customers as a keyed table of some files in each of eight buckets, and the customers themselves."""
    rows = inputs.table(spark, folder, "customer")
    table = KeyedFiles.create(
        spark, fresh_path(spark, "customers"), rows.schema, ["c_custkey"], buckets=8, file_rows=max(50, rows.count() // 32)
    )
    table.insert(rows)
    return table, rows


def files_upsert(spark: SparkSession, folder: str) -> DataFrame:
    table, _ = _customer_files(spark, folder)
    table.upsert(stacking.stack_by_name([inputs.changed_customers(spark, folder), inputs.new_customers(spark, folder)]))
    return table.read()


def files_update(spark: SparkSession, folder: str) -> DataFrame:
    table, _ = _customer_files(spark, folder)
    table.update(inputs.changed_customers(spark, folder).select("c_custkey", "c_acctbal"))
    return table.read()


def merged_deltas(spark: SparkSession, folder: str) -> DataFrame:
    """A table with three deltas, as merged on reading, and as compacted."""
    table, rows = _customer_files(spark, folder)
    table.insert(inputs.new_customers(spark, folder))
    table.merge(inputs.changed_customers(spark, folder))
    # Changes some customers for the second time, and some of the new ones.
    again = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    every = rows.withColumn("c_acctbal", again).unionByName(inputs.new_customers(spark, folder))
    table.merge(every.where(F.col("c_nationkey") < 5).withColumn("c_acctbal", F.col("c_acctbal") + 100))
    merged = table.read()
    table.compact()
    return stacking.stack_tagged({"merged": merged, "compacted": table.read()})


def _zoned(spark: SparkSession, folder: str) -> VersionedTable:
    """Readings that arrive in three parts, with the times and machines of every file noted."""
    rows = written(inputs.readings(spark, folder), "readings")
    table = VersionedTable(spark, fresh_path(spark, "zoned"))
    table.create(rows.schema, ["datetime", "equipmentid"])
    for n in range(len(ARRIVALS) + 1):
        table.append(rows.where(_period() == n), run=str(n), arrange=lambda part: part.repartitionByRange("datetime", "equipmentid"))
    return table


def zoned_since_mark(spark: SparkSession, folder: str) -> DataFrame:
    """Readings after a mark, from the files that may have some."""
    return versions.rows_after(_zoned(spark, folder), "datetime", ARRIVALS[0]).select("linenmb", "equipmentid", "mcid", "datetime")


def zoned_mark(spark: SparkSession, folder: str) -> DataFrame:
    """The newest time, from what is noted of the files."""
    return versions.newest(_zoned(spark, folder), "datetime")


def whole_job(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts of the inspection job: readings up to a mark, then all, then what was kept back."""
    root = fresh_path(spark, "job")
    rows = inputs.readings(spark, folder).withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"))
    files.write_templates(inputs.template_rows(spark, folder), f"{root}/templates")
    inputs.model_list(spark, folder).write.option("header", True).csv(f"{root}/models")
    inputs.equipment(spark, folder).write.option("header", True).csv(f"{root}/equipment")
    settings = inspection.Settings(
        readings=f"{root}/readings",
        templates=f"{root}/templates",
        model_list=f"{root}/models",
        equipment=f"{root}/equipment",
        verdicts=f"{root}/verdicts",
        reports=f"{root}/reports",
        mark=f"{root}/mark",
        withhold_open=True,
    )
    lines = [(f"{name}={value}",) for name, value in asdict(settings).items() if value != ""]
    spark.createDataFrame(lines, "line string").coalesce(1).write.text(f"{root}/settings")
    settings = inspection.read_settings(spark, f"{root}/settings")
    early = F.col("datetime") <= inputs.MARK
    for part in (rows.where(early), rows.where(~early)):
        part.write.mode("append").parquet(settings.readings)
        inspection.run_inspection(spark, settings)
    inspection.close_inspection(spark, settings)
    return spark.read.schema(S.VERDICTS).parquet(f"{settings.verdicts}/*")


def cutoff_rows(spark: SparkSession, folder: str) -> DataFrame:
    first = fn.midnight(F.lit("1997-05-20").cast("date"))
    rows = increments.from_day(inputs.readings(spark, folder), first.cast("timestamp_ntz"))
    return rows.select("linenmb", "equipmentid", "datetime")


def number_texts(spark: SparkSession, folder: str) -> DataFrame:
    price, tax = F.col("l_extendedprice") / 7, F.col("l_tax") / 8
    rows = inputs.table(spark, folder, "lineitem")
    rows = rows.select(fn.fixed_decimals(price).alias("price"), fn.fixed_decimals(tax, 3).alias("tax"))
    return rows.groupBy("price", "tax").agg(F.count("*").alias("n_rows"))


def url_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.table(spark, folder, "pages").select("page_id", fn.suffix(F.col("url")).alias("suffix"))


def packed_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Machine, model and time in one text, with the parts taken out again."""
    rows = inputs.readings(spark, folder).select(
        fn.joined([F.col("equipmentid"), F.col("mcid"), F.col("datetime")]).alias("packed")
    )
    parts = F.split("packed", "_")
    rows = rows.select("packed", parts[0].alias("equipmentid"), parts[1].alias("mcid"))
    return rows.groupBy("packed", "equipmentid", "mcid").agg(F.count("*").alias("n_rows"))


def later_times(spark: SparkSession, folder: str) -> DataFrame:
    """The newest time of every machine, but not before the mark."""
    rows = inputs.readings(spark, folder).groupBy("equipmentid").agg(F.max("datetime").alias("datetime"))
    mark = F.lit(inputs.MARK).cast("timestamp_ntz")
    return rows.select("equipmentid", fn.later(F.col("datetime"), mark).alias("datetime"))


def point_states(spark: SparkSession, folder: str) -> DataFrame:
    """Distance between the two points of a reading, its deviation from 50, and whether that is above 20."""
    rows = inputs.lines(spark, folder)
    apart = fn.distance(F.col("leadx"), F.col("leady"), F.col("padx"), F.col("pady"))
    rows = rows.select("equipmentid", "datetime", "linenmb", apart.alias("apart"))
    rows = rows.withColumn("offset", fn.deviation(F.col("apart"), F.lit(50.0)))
    return rows.withColumn("state", fn.out_of_tolerance(F.col("offset"), F.lit(20.0)).cast("int"))


def verdict_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Codes as the two texts of a report, counted."""
    rows = sample_codes(spark, folder)
    rows = rows.select("code", fn.result_text(F.col("code")).alias("result"), fn.code_text(F.col("code")).alias("text"))
    return rows.groupBy("code", "result", "text").agg(F.count("*").alias("samples"))


def withheld_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts of two runs, the second starting with the open samples of the first."""
    rows = inputs.readings(spark, folder)
    templates = inputs.templates(spark, folder)

    def run(part: DataFrame) -> tuple[DataFrame, DataFrame]:
        part = written(part, "rows")
        return increments.withheld(part, written(increments.open_from(part), "open"))

    closed, still_open = run(rows.where(F.col("datetime") <= F.lit(inputs.MARK)))
    later, rest = run(still_open.unionByName(increments.since(rows, inputs.MARK)))
    parts = [checks.check(typed_lines(part), templates) for part in (closed, later, rest)]
    return stacking.stack_by_name(parts)


def open_samples(spark: SparkSession, folder: str) -> DataFrame:
    return increments.open_from(inputs.readings(spark, folder))


def closed_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.readings(spark, folder)
    closed, _ = increments.withheld(rows, written(increments.open_from(rows), "open"))
    return closed.groupBy("equipmentid", "mcid").agg(F.count("*").alias("n_rows"))


def template_files(spark: SparkSession, folder: str) -> DataFrame:
    """Templates written per model under its file name, all read back in one pass."""
    path = fresh_path(spark, "templates")
    files.write_templates(inputs.template_rows(spark, folder), path)
    return files.read_templates(spark, path)


def template_kinds(spark: SparkSession, folder: str) -> DataFrame:
    """The templates in three files of different kinds, each read as the end of its name says."""
    path = fresh_path(spark, "kinds")
    rows = inputs.template_rows(spark, folder)
    kinds = {"csv": lambda w, to: w.option("header", True).csv(to), "json": lambda w, to: w.json(to), "parquet": lambda w, to: w.parquet(to)}
    schema = rows.schema
    parts = []
    for n, (kind, write) in enumerate(kinds.items()):
        to = f"{path}/part.{kind}"
        write(rows.where(F.pmod(F.crc32("model_key"), F.lit(len(kinds))) == n).write, to)
        parts.append(files.read_by_suffix(spark, to, schema).withColumn("kind", F.lit(kind)))
    return stacking.stack_by_name(parts)


def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "equipment")
    inputs.equipment(spark, folder).write.option("header", True).csv(path)
    return files.read_equipment(spark, path)


def json_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "template") + ".json"
    inputs.template_rows(spark, folder).write.json(path)
    return files.read_json(spark, path, inputs.template_rows(spark, folder).schema)


def parquet_scan(spark: SparkSession, folder: str) -> DataFrame:
    return files.read_by_suffix(spark, f"{folder.rstrip('/')}/part.parquet")


def report_files(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "report")
    files.write_report(alert_lines(spark, folder), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def boosted_scores(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.table(spark, folder, "embeddings").withColumn("label", (F.col("label") > 4).cast("double"))
    rows = classify.features_from_array(rows, "embedding")
    train, test = classify.hold_out(rows, "vec_id", 0.25, seed=7)
    params = {"maxIter": 5, "maxDepth": 3}
    scored = classify.run_classifier("trainAndPredict", {"train": train, "test": test}, params=params)
    return scored.rows.select("vec_id", "label", "prediction")


def _small_numbers(rows: DataFrame) -> DataFrame:
    """The vectors as features of a few whole numbers each, and whether the label is one of the upper half."""
    rows = rows.withColumn("label", (F.col("label") > 4).cast("double"))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 8).cast("double"))
    return classify.features_from_array(rows.withColumn("embedding", whole), "embedding")


def boosted_stump(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of held-out rows by a model of one split, which is trained, saved, loaded and applied."""
    rows = _small_numbers(inputs.table(spark, folder, "embeddings"))
    train, test = classify.hold_out(rows, "vec_id", 0.25, seed=7)
    path = fresh_path(spark, "model")
    classify.run_classifier("train", {"train": train}, params={"maxIter": 1, "maxDepth": 1}, model_path=path)
    scored = classify.run_classifier("loadAndPredict", {"test": test}, model_path=path)
    return scored.rows.select("vec_id", "label", "prediction")


def score_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    """Hits and misses at every threshold of a score with many ties, and the area under the curve."""
    rows = inputs.table(spark, folder, "embeddings")
    rows = rows.select((F.col("label") > 4).cast("int").alias("label"), F.floor(F.col("embedding")[0].cast("double") * 40).alias("score"))
    counts = written(ranks.threshold_counts(rows), "thresholds")
    area = ranks.area_under_curve(counts).select("area")
    return counts.join(F.broadcast(area))


def table_life(spark: SparkSession, folder: str) -> DataFrame:
    """A keyed table that is created, filled in two appends, read, and dropped."""
    rows = inputs.table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    name = f"linecheck_{uuid.uuid4().hex}"
    tables.create_table(spark, name, [("c_custkey", "long", False), ("c_name", "string", True), ("c_acctbal", "double", True)], ["c_custkey"])
    debtors = F.col("c_acctbal") < 0
    for part in (rows.where(debtors), rows.where(~debtors).select("c_acctbal", "c_custkey", "c_name")):
        tables.append_rows(part, name)
    found = written(tables.read_table(spark, name), "table-life")
    tables.drop_table(spark, name)
    return found


def stored_mark(spark: SparkSession, folder: str) -> DataFrame:
    """The newest time, written as the mark and read again; before that there is the default."""
    path = fresh_path(spark, "mark")
    before = files.read_mark(spark, path, inputs.MARK)
    files.write_mark(increments.new_mark(inputs.readings(spark, folder)), path)
    return files.literal_rows(spark, [(before, files.read_mark(spark, path, inputs.MARK))], ["before", "mark"])


def _streamed(spark: SparkSession, folder: str, part: Column, parts: int) -> str:
    """Output folder of a stream of readings that is stopped and started again between its parts."""
    root = fresh_path(spark, "stream")
    rows = inputs.readings(spark, folder).withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"))
    templates = written(inputs.templates(spark, folder), "templates")
    for n in range(parts):
        rows.where(part == n).write.mode("append").parquet(f"{root}/in")
        source = inspect.read_stream(spark, f"{root}/in", rows.schema)
        query = inspect.inspect_stream(source, templates, f"{root}/out", f"{root}/progress")
        query.awaitTermination()
    inspect.close_open_samples(spark, rows.schema, templates, f"{root}/out", query.lastProgress["batchId"])
    return f"{root}/out"


def _period() -> Column:
    """Number of the arrival that a reading belongs to by its time."""
    return sum((F.col("datetime") >= time).cast("int") for time in ARRIVALS)


def streamed_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """The verdicts from a stream of readings that arrive in three parts.

    The stream is stopped and started again between them.
    """
    return inspect.read_verdicts(spark, _streamed(spark, folder, _period(), len(ARRIVALS) + 1))


def streamed_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Readings that come too late for their sample: arrivals overlap, as lines of one number come one part later."""
    part = _period() + (F.col("linenmb") == LATE_LINE).cast("int")
    late = inspect.read_late(spark, _streamed(spark, folder, part, len(ARRIVALS) + 2))
    return late.select("equipmentid", "mcid", "linenmb", "datetime", "open_from", "batch")


def _by_state(spark: SparkSession, folder: str, part: Column, parts: int) -> str:
    """As ``_streamed``, with the open samples in Spark's state store."""
    root = fresh_path(spark, "stream")
    rows = inputs.readings(spark, folder).withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"))
    rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in S.LINES])
    templates = written(inputs.templates(spark, folder), "templates")
    for n in range(parts):
        rows.where(part == n).write.mode("append").parquet(f"{root}/in")
        source = inspect.read_stream(spark, f"{root}/in")
        keyed_state.inspect_stream(source, templates, f"{root}/out", f"{root}/progress").awaitTermination()
    keyed_state.close_open_samples(spark, templates, f"{root}/out", f"{root}/progress")
    return f"{root}/out"


def stated_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """The verdicts of a stream in three parts that keeps open samples in its state."""
    return keyed_state.read_verdicts(spark, _by_state(spark, folder, _period(), len(ARRIVALS) + 1))


def stated_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What is late in a stream that keeps open samples in its state, of arrivals that overlap."""
    part = _period() + (F.col("linenmb") == LATE_LINE).cast("int")
    late = keyed_state.read_late(spark, _by_state(spark, folder, part, len(ARRIVALS) + 2))
    return late.select("equipmentid", "mcid", "linenmb", "datetime", "open_from", "batch")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        scan_since_mark,
        keyed_scan,
        named_view,
        new_mark,
        clean_coordinates,
        model_keys,
        listed_lines,
        segment_lines,
        segment_lines_in_slots,
        segment_events,
        segment_events_in_slots,
        sample_sizes,
        sample_sizes_in_slots,
        template_lines,
        template_counts,
        line_steps,
        line_steps_in_slots,
        line_offsets,
        sample_codes,
        sample_verdicts,
        sample_verdicts_in_slots,
        models_without_template,
        alerts,
        alert_lines,
        first_alerts,
        quality_summary,
        stacked_parties,
        tagged_parts,
        keyed_insert,
        keyed_upsert,
        keyed_update,
        results_once,
        files_upsert,
        files_update,
        merged_deltas,
        zoned_since_mark,
        zoned_mark,
        whole_job,
        cutoff_rows,
        number_texts,
        url_suffixes,
        packed_ids,
        later_times,
        point_states,
        verdict_texts,
        open_samples,
        closed_rows,
        withheld_runs,
        template_files,
        template_kinds,
        csv_scan,
        json_scan,
        parquet_scan,
        report_files,
        boosted_scores,
        boosted_stump,
        score_thresholds,
        table_life,
        stored_mark,
        streamed_verdicts,
        streamed_late_rows,
        stated_verdicts,
        stated_late_rows,
    )
}
