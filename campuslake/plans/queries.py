"""Queries over the driver's tables, one or more for each operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cost, events, gpa, matching, replay, timeline, visa
from ..sources import catalogs as cat
from ..sources import facts
from ..sources.scratch import load, shared_dir, written
from ..streaming import streams
from . import inputs

Query = Callable[[SparkSession, str], DataFrame]
_ALL: dict[str, Query] = {}


def query(f: Query) -> Query:
    _ALL[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_ALL)


@query
def gpa_standard40(s, d):
    return gpa.weighted_gpa(inputs.transcripts(s, d), "standard40")


@query
def gpa_all_scales(s, d):
    return gpa.weighted_gpa_all(inputs.transcripts(s, d)).select("student_id", "scale_id", "gpa", "total_credits")


@query
def gpa_best_scale(s, d):
    return gpa.best_scale(inputs.transcripts(s, d))


@query
def gpa_cta_tier(s, d):
    return gpa.cta_tier(gpa.weighted_gpa(inputs.transcripts(s, d), "pku40")).select("student_id", "gpa", "cta_tier")


@query
def gpa_score_flags(s, d):
    return gpa.flag_score_range(inputs.transcripts(s, d)).drop("course_id")


@query
def gpa_points(s, d):
    return gpa.to_points_all(gpa.valid_courses(inputs.transcripts(s, d))).select("student_id", "score", "scale_id", "points_x10")


@query
def course_numbers(s, d):
    typed = F.when(F.col("l_linenumber") % 3 == 0, F.lit("none")).otherwise(F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(" credits")))
    score = F.concat(((F.col("l_partkey") * 7) % 106).cast("string"), F.lit(".0"))
    return gpa.coerce_course_numbers(load(s, d, "lineitem").select(F.col("l_orderkey").alias("student_id"), typed.alias("credits"), score.alias("score")))


@query
def cost_estimate(s, d):
    return cost.estimate_costs(inputs.cost_requests(s, d))


@query
def cost_labels(s, d):
    return cost.cost_labels(inputs.cost_requests(s, d)).drop("duration")


@query
def gpa_band_lookup(s, d):
    """Bands looked up in the catalog's rows."""
    return gpa.to_points_by_table(gpa.valid_courses(inputs.transcripts(s, d)), "ustc43").select("student_id", "score", "points_x10")


#: A scale that is no part of the catalog.
HONOURS = ("honours50", 50, [(90, 50), (75, 40), (60, 25)])


@query
def gpa_registered_scale(s, d):
    return gpa.weighted_gpa(inputs.transcripts(s, d), HONOURS[0], gpa.register_scale(*HONOURS))


@query
def gpa_scale_summary(s, d):
    return gpa.scale_summary(inputs.transcripts(s, d))


@query
def school_demand(s, d):
    return matching.school_demand(inputs.applicants(s, d)).withColumn("tags", F.array_join("tags", ","))


@query
def visa_fees(s, d):
    """What the further fees of all valid requests of a visa come to."""
    wanted = visa.valid_visa_requests(inputs.visa_requests(s, d)).groupBy("visa_id").agg(F.count("*").alias("n_requests"))
    return visa.visa_fees(s).join(wanted, "visa_id").withColumn("sum_cny", F.col("n_requests") * F.col("total_cny"))


@query
def event_sites(s, d):
    """The sites that emit events, with the number of their events and labels."""
    rows = event_envelope(s, d)
    return rows.groupBy("name", "event_category").agg(F.count("*").alias("n_events"), F.countDistinct("event_label").alias("n_labels"))


@query
def cost_default_duration(s, d):
    return cost.default_durations(inputs.cost_requests(s, d)).select("request_id", "country", "degree", "default_duration")


@query
def cost_cta(s, d):
    return cost.cost_cta(cost.estimate_costs(inputs.cost_requests(s, d))).select("request_id", "total_budget", "total_medium", "cta_tier")


@query
def cost_form_replay(s, d):
    return replay.replay_cost_form(inputs.cost_log(s, d))


@query
def gpa_validation(s, d):
    return matching.validate_gpa(inputs.applicants(s, d)).select("applicant_id", "gpa_text", "gpa", "gpa_error")


@query
def school_match(s, d):
    return matching.match_schools(inputs.applicants(s, d))


@query
def school_rank(s, d):
    return matching.school_ranks(inputs.applicants(s, d))


@query
def school_shortlist(s, d):
    return matching.school_shortlist(inputs.applicants(s, d))


@query
def school_summary(s, d):
    return matching.school_counts(inputs.applicants(s, d))


@query
def selection_replay(s, d):
    return replay.replay_selection(inputs.selections(s, d)).withColumn("selected", F.array_join("selected", ","))


@query
def visa_items(s, d):
    """The items with the number of valid requests that need them."""
    wanted = visa.valid_visa_requests(inputs.visa_requests(s, d)).groupBy("visa_id").agg(F.count("*").alias("n"))
    return visa.visa_items(s).join(wanted, "visa_id", "left").withColumn("n_requests", F.coalesce("n", F.lit(0).cast("long"))).drop("n")


@query
def visa_checklist(s, d):
    return visa.visa_checklist(inputs.visa_requests(s, d)).select("request_id", "user_id", "country_id", "visa_id", "section_no", "item_no", "item_id", "name", "required", "needs_translation")


@query
def visa_summary(s, d):
    return visa.valid_visa_requests(inputs.visa_requests(s, d)).select("request_id", "visa_id").join(F.broadcast(visa.visa_summary(s)), "visa_id")


@query
def visa_tips(s, d):
    return visa.valid_visa_requests(inputs.visa_requests(s, d)).select("request_id", "visa_id").join(F.broadcast(visa.visa_tips(s).drop("country_id")), "visa_id")


@query
def visa_progress(s, d):
    return visa.mask_progress(inputs.visa_requests(s, d), replay.checklist_masks(inputs.toggles(s, d)))


@query
def checked_state_json(s, d):
    """State written as JSON, and the number of items that reading it back finds."""
    state = inputs.toggles(s, d).groupBy("user_id", "item_id").agg((F.count("*") % 2 == 1).alias("checked"))
    return visa.read_checked(visa.write_checked(state), "json").select("user_id", "json", F.size("checked").cast("long").alias("n_read"))


def _stages(s, d):
    return timeline.timeline_stages(inputs.timeline_requests(s, d)).withColumn("core_tasks", F.array_join("core_tasks", ";"))


@query
def timeline_stages(s, d):
    return _stages(s, d).drop("grade", "major", "tier", "round")


@query
def timeline_masked(s, d):
    return timeline.mask_locked(_stages(s, d)).drop("country", "level", "grade", "major", "tier", "round")


@query
def timeline_first_locked(s, d):
    return timeline.first_locked_of(inputs.timeline_requests(s, d))


@query
def timeline_form_replay(s, d):
    return replay.replay_timeline_form(inputs.timeline_log(s, d))


@query
def course_log_replay(s, d):
    return replay.replay_courses(inputs.course_log(s, d))


@query
def event_envelope(s, d):
    return events.event_envelope(inputs.interactions(s, d)).select("event_id", "user_id", "envelope.*")


@query
def event_rollup(s, d):
    return events.event_rollup(event_envelope(s, d))


@query
def stream_progress(s, d):
    out = streams.checked_stream(inputs.toggle_rows(streams.read_stream(s, d, "events")))
    return streams.latest(streams.run_to_table(out, "update"), ["user_id", "item_id"])


@query
def stream_event_counts(s, d):
    rows = inputs.interaction_rows(streams.read_stream(s, d, "events"))
    labelled = events.event_envelope(rows).select("ts", "envelope.*")
    return streams.run_to_table(streams.event_counts_stream(labelled), "append").drop("batch")


@query
def gpa_chosen_scale(s, d):
    """Each student on the scale of their choice; one scale is registered by rows."""
    further = s.createDataFrame([(HONOURS[0], HONOURS[0], HONOURS[1], float(b), p) for b, p in HONOURS[2]], cat.grade_scales(s).schema)
    return gpa.weighted_gpa_by_scale(inputs.scaled_transcripts(s, d), cat.grade_scales(s).unionByName(further))


@query
def event_rollup_weekly(s, d):
    """Weeks merged from a table of days."""
    rows = events.event_envelope(inputs.interactions(s, d)).select("ts", "user_id", "envelope.*")
    daily = written(events.daily_rollup(rows), "daily", "day")
    return events.span_rollup(daily, F.date_trunc("week", "day").cast("date")).withColumnRenamed("span", "week")


@query
def facts_checked(s, d):
    """Raw transcripts held against their schema."""
    return facts.checked(inputs.raw_transcripts(s, d), "transcripts").select("course_id", "student_id", "name", "credits", "score", "reason")


@query
def stored_state_read(s, d):
    """Stored checklists, broken ones too: what reading finds."""
    read = visa.read_checked(inputs.stored_states(s, d), "json")
    checked = F.size(F.filter(F.map_values("checked"), lambda c: F.coalesce(c, F.lit(False))))
    return read.select("event_id", F.size("checked").cast("long").alias("n_read"), checked.cast("long").alias("n_checked"))


@query
def stream_checklists(s, d):
    """Live checklists, kept as JSON text: toggles arrive in several files, in two runs of the stream."""
    folder = f"{shared_dir(s)}/campuslake/checklists-{uuid.uuid4().hex}"
    rows = inputs.arrivals(load(s, d, "events"))
    for run in range(4):
        rows.where(F.col("run") == run).drop("run").coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
        if run % 2:
            streams.run_checklists(inputs.toggle_rows(streams.read_stream(s, folder, "events", 1)), folder, every=3)
    return streams.checklists(s, folder)


@query
def stream_late_events(s, d):
    """Windows of events that arrive in four runs, some of them too late; and how many came too late in each run."""
    folder = f"{shared_dir(s)}/campuslake/windows-{uuid.uuid4().hex}"
    rows = inputs.arrivals(load(s, d, "events"))
    for run in range(4):
        rows.where(F.col("run") == run).drop("run").coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
        arrived = events.event_envelope(inputs.interaction_rows(streams.read_stream(s, folder, "events"))).select("ts", "envelope.*")
        streams.run_windows(arrived, folder)
    counted = streams.closed_windows(s, folder).select(F.lit("window").alias("kind"), F.col("window_start").cast("string").alias("at"), "event_category", "event_label", "n")
    late = streams.window_runs(s, folder).select(F.lit("late").alias("kind"), F.concat(F.lit("run "), F.col("run")).alias("at"), F.col("n_late").alias("n"))
    return counted.unionByName(late, allowMissingColumns=True)
