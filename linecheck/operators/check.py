"""Compare samples with the golden templates and give each a verdict.

Rules that are easy to get wrong:

* A sample's lines are its distinct (line, coordinates) tuples. The same line number
  with other coordinates counts again.
* Lines are compared with the template by position in their order, not by number.
  Ties of the line number are ordered by the coordinates.
* The first line has distance 0 and is always reported as line 1.
* Fewer lines than the template: lines missing. As many: compared. More: the sample
  gets no verdict at all.
* Models without a template get no verdict; ``missing_templates`` lists them.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linecheck import functions as fn
from linecheck import schemas as S
from linecheck.operators.lookup import lookup, on
from linecheck.operators.measured import is_small, small_side, written
from linecheck.operators.prepare import starts_sample
from linecheck.operators.template import MEASURES, template_positions
from linecheck.operators.timeline import DEFAULT_LIMIT, calm_rows, place, running_start, settled_rows

SAMPLE = (*S.HISTORY, "sample_ts")
LINE = ("linenmb", *S.COORDINATES)


class Lane(NamedTuple):
    """Distinct lines of samples; ``owner`` are the columns they are partitioned by.

    ``bounded`` says that no sample can be larger than a task sorts.
    """

    lines: DataFrame
    owner: tuple[str, ...]
    bounded: bool


def sample_lanes(lines: DataFrame, slot: str | Column = "day", limit: int | None = DEFAULT_LIMIT) -> list[Lane]:
    """Distinct lines per sample, the whole of every sample in one lane.

    Normally there is one lane. Samples so large that their rows skipped the window
    of the segmentation go to a second one: its rows are made distinct under a hash of
    all columns, so neither many copies nor many lines of one sample meet in one task.
    """
    lines = lines.select(*S.HISTORY, "datetime", *LINE)
    placed = place(lines, S.HISTORY, "datetime", starts_sample(), slot, limit)
    if placed is None:
        rows = lines.withColumn("sample_ts", running_start(S.HISTORY, "datetime", starts_sample()))
        return [Lane(rows.drop("datetime").distinct(), S.HISTORY, True)]

    home = (*S.HISTORY, "home")
    calm = calm_rows(placed, S.HISTORY, "datetime", starts_sample(), "sample_ts").drop("datetime")
    if placed.settled_samples is None:
        return [Lane(calm.distinct(), home, True)]

    large = small_side(placed.settled_samples)
    pairs = [*on(S.HISTORY), ("sample_ts", "known_start")]
    beside = calm_rows(placed, S.HISTORY, "datetime", starts_sample(), "sample_ts", large)
    columns = [*SAMPLE, *LINE]
    busy = settled_rows(placed, "sample_ts").select(*columns)
    busy = busy.unionByName(lookup(beside, large, pairs, "left_semi").select(*columns))
    return [
        Lane(lookup(calm, large, pairs, "left_anti").distinct(), home, True),
        Lane(written(busy.distinct(), "busy"), SAMPLE, False),
    ]


def sample_sizes(lines: DataFrame, *, slot: str | Column = "day", limit: int | None = DEFAULT_LIMIT) -> DataFrame:
    """Number of distinct lines of every sample."""
    sizes = [
        lane.lines.groupBy(*dict.fromkeys([*lane.owner, *SAMPLE]))
        .agg(F.count("*").cast("int").alias("n_lines"))
        .select(*SAMPLE, "n_lines")
        for lane in sample_lanes(lines, slot, limit)
    ]
    return reduce(DataFrame.unionByName, sizes)


def _not_above(lane: Lane, std: DataFrame) -> DataFrame:
    """Lines of a lane without the samples that have more lines than their template.

    Sizes come from a partial aggregation. The samples left over are at most as large
    as a template, and so is what a window over them has to sort.
    """
    sizes = lane.lines.groupBy(*SAMPLE).agg(F.count("*").alias("found"))
    sizes = sizes.withColumn("model_key", fn.model_key(F.col("mcid")))
    wanted = std.select("model_key", "n_std").distinct()
    fitting = sizes.join(wanted, "model_key").where(F.col("found") <= F.col("n_std"))
    return lookup(lane.lines, small_side(fitting.select(*SAMPLE)), on(SAMPLE), "left_semi")


def _steps(lane: Lane, lines: DataFrame) -> DataFrame:
    """Position, reported number and distances to the line before, per sample."""
    owner = list(dict.fromkeys([*lane.owner, *SAMPLE]))
    sample = Window.partitionBy(*dict.fromkeys([*lane.owner, "sample_ts"]))
    order = sample.orderBy(*LINE)
    placed = lines.select(
        "*",
        F.row_number().over(order).alias("pos"),
        *[F.lag(name).over(order).alias(f"{name}_before") for name in S.COORDINATES],
    )

    def step(x: str, y: str) -> Column:
        before = fn.distance(F.col(x), F.col(y), F.col(f"{x}_before"), F.col(f"{y}_before"))
        return F.coalesce(before, F.lit(0.0))

    return placed.select(
        *owner,
        fn.model_key(F.col("mcid")).alias("model_key"),
        F.count("*").over(sample).cast("int").alias("n_lines"),
        "pos",
        F.when(F.col("pos") == 1, F.lit(1)).otherwise(F.col("linenmb")).alias("line"),
        step("leadx", "leady").alias("lead_step"),
        step("padx", "pady").alias("pad_step"),
    )


def sample_steps(lines: DataFrame, *, slot: str | Column = "day", limit: int | None = DEFAULT_LIMIT) -> DataFrame:
    """Every line of every sample: position, reported number and distances to the line before.

    With a ``limit``, samples with more lines than that stay together in one task all the same, as
    their lines have one order; the sort spills.
    """
    columns = [*SAMPLE, "n_lines", "pos", "line", "lead_step", "pad_step"]
    frames = [_steps(lane, lane.lines).select(*columns) for lane in sample_lanes(lines, slot, limit)]
    return reduce(DataFrame.unionByName, frames)


def _compared(lines: DataFrame, templates: DataFrame, slot: str | Column, limit: int | None) -> list[Lane]:
    """Lines joined to the template line of their position, lane by lane."""
    std = template_positions(templates).drop("line")
    models = templates.select("model_key").distinct()
    if is_small(templates):
        std, models = F.broadcast(std), F.broadcast(models)
    lines = lines.join(models, "model_key", "left_semi")
    lanes = []
    for lane in sample_lanes(lines, slot, limit):
        fitting = lane.lines if lane.bounded else _not_above(lane, std)
        steps = _steps(lane, fitting).join(std, ["model_key", "pos"]).where(F.col("n_lines") <= F.col("n_std"))
        lead = fn.deviation(F.col("lead_step"), F.col("lead_diff"))
        pad = fn.deviation(F.col("pad_step"), F.col("pad_diff"))
        bad = fn.out_of_tolerance(F.col("lead_offset"), F.col("lead_limit")) | fn.out_of_tolerance(
            F.col("pad_offset"), F.col("pad_limit")
        )
        steps = steps.withColumn("lead_offset", lead).withColumn("pad_offset", pad).withColumn("bad", bad)
        lanes.append(Lane(steps.drop(*MEASURES), lane.owner, True))
    return lanes


def full_samples(
    lines: DataFrame, templates: DataFrame, *, slot: str | Column = "day", limit: int | None = DEFAULT_LIMIT
) -> DataFrame:
    """Every line of the samples that have as many lines as their template.

    Columns: the sample, position, reported number, distances to the line before, their
    deviations from the template and whether the line is out of tolerance.
    """
    frames = [
        lane.lines.where(F.col("n_lines") == F.col("n_std")).select(
            *SAMPLE, "pos", "line", "lead_step", "pad_step", "lead_offset", "pad_offset", "bad"
        )
        for lane in _compared(lines, templates, slot, limit)
    ]
    return reduce(DataFrame.unionByName, frames)


def _code() -> Column:
    failed = F.max((F.col("n_lines") == F.col("n_std")) & F.col("bad"))
    return (
        F.when(F.col("n_lines") < F.col("n_std"), S.LINES_MISSING)
        .when(failed, S.OUT_OF_TOLERANCE)
        .otherwise(S.QUALIFIED)
    )


def _per_sample(
    lines: DataFrame, templates: DataFrame, slot: str | Column, limit: int | None, values: list[Column]
) -> DataFrame:
    frames = [
        lane.lines.groupBy(*dict.fromkeys([*lane.owner, *SAMPLE]), "n_lines", "n_std").agg(*values)
        for lane in _compared(lines, templates, slot, limit)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def sample_codes(
    lines: DataFrame, templates: DataFrame, *, slot: str | Column = "day", limit: int | None = DEFAULT_LIMIT
) -> DataFrame:
    """Verdict code and number of lines of every sample."""
    checked = _per_sample(lines, templates, slot, limit, [_code().alias("code")])
    return checked.select("equipmentid", "mcid", F.col("sample_ts").alias("datetime"), "n_lines", "n_std", "code")


def check(
    lines: DataFrame,
    templates: DataFrame,
    *,
    decimals: int = 2,
    slot: str | Column = "day",
    limit: int | None = DEFAULT_LIMIT,
) -> DataFrame:
    """Verdicts (equipmentid, mcid, datetime, code, description) of typed lines.

    ``limit`` is the number of rows a task may have to sort. Where a history has more, it is
    cut into slots of the given width, see ``timeline``. None skips the measurement.
    """
    failed = (F.col("n_lines") == F.col("n_std")) & F.col("bad")
    text = fn.line_text(F.col("line"), F.col("lead_offset"), F.col("pad_offset"), decimals)
    # At most as many as the template has lines.
    failures = F.collect_list(F.when(failed, F.struct("pos", text.alias("text"))))
    in_order = F.transform(F.array_sort("failures"), lambda f: f["text"])
    checked = _per_sample(lines, templates, slot, limit, [_code().alias("code"), failures.alias("failures")])
    description = (
        F.when(F.col("code") == S.LINES_MISSING, fn.missing_lines_text(F.col("n_lines"), F.col("n_std")))
        .when(F.col("code") == S.OUT_OF_TOLERANCE, F.concat_ws(S.LINE_DELIMITER, in_order))
        .otherwise(S.QUALIFIED_TEXT)
    )
    return checked.select(
        "equipmentid", "mcid", F.col("sample_ts").alias("datetime"), "code", description.alias("description")
    )
