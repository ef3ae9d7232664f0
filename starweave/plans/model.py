"""The worked star model, tables route.

Three dimensions and three facts built from the staging tables. Each builder
returns the table columns plus, where the next step needs it, the raw natural
key (``raw_*``) that the load leaves out. Surrogate keys come from
``dense_key`` (distributed, checkpointed), ordered by the view's key order
with the raw natural key last so the order is total and the keys are stable.

Plan shape: every dimension is built once and reused by the facts. The score
fact does not walk score → aspect → performance → event → judge → person as
five joins of big tables: the aspect fact already knows its event, so the
scores take (perf_aspect_id, event_id) in one shuffle join on the aspect id
and the judge in one join to the (event, role) → judge map, which is
(event, judge) sized.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators.joins import broadcast_if_small, nulls_dealt
from ..operators.keys import dense_key
from ..operators.reshape import union_branches
from ..session import materialize
from ..sources.schemas import columns_of
from . import staging as stg


# ----------------------------------------------------------------- D2 d_event
def event_view(perfs: DataFrame) -> DataFrame:
    """s_event_v: one row per (competition, program string) with its entry
    count; program and element split from the string."""
    g = perfs.groupBy("competition_nm", "program_event_nm").agg(F.count(F.lit(1)).alias("entries_ct"))
    pe = F.col("program_event_nm")
    shaped = g.select(
        "competition_nm",
        S.program_of(pe).alias("program_nm"),
        S.element_of(pe).alias("element_nm"),
        "entries_ct",
        pe.alias("raw_event_nm"),
    )
    return dense_key(shaped, ["competition_nm", "program_nm", "element_nm", "raw_event_nm"], "event_id")


# ---------------------------------------------------------------- D1 d_person
def raw_people(perfs: DataFrame, judges: DataFrame) -> DataFrame:
    """Distinct (nationality, gender, name) over judges and skaters.

    The four skater branches (ladies, men, first and second of a pair) are one
    scan of the performances (``union_branches``), not four.
    """
    nm = F.col("skater_nm")
    pe = F.col("program_event_nm")
    slash = F.instr(nm, "/")
    skaters = union_branches(perfs, [
        (pe.like("%Ladies%"), {"nationality": F.col("nationality"), "gender": F.lit("F"), "nm": nm}),
        (pe.like("%Men%"), {"nationality": F.col("nationality"), "gender": F.lit("M"), "nm": nm}),
        (nm.like("%/%"), {"nationality": F.col("nationality"), "gender": F.lit("F"),
                          "nm": F.trim(nm.substr(F.lit(1), slash - 1))}),
        (nm.like("%/%"), {"nationality": F.col("nationality"), "gender": F.lit("M"),
                          "nm": F.trim(nm.substr(slash + 1, F.lit(1 << 30)))}),
    ])
    js = judges.select("nationality", F.lit(None).cast("string").alias("gender"), F.col("judge_nm").alias("nm"))
    return js.unionByName(skaters).distinct()


def person_view(perfs: DataFrame, judges: DataFrame) -> DataFrame:
    people = S.with_name_parts(raw_people(perfs, judges), "nm").select(
        "forename", "surname", "gender", "nationality", F.col("nm").alias("raw_nm"))
    # names are cut once: the range sample of the dense key reads what was cut
    return dense_key(people, ["surname", "forename", "nationality", "gender", "raw_nm"], "person_id", by_position=True)


# ---------------------------------------------------------------- D3 d_aspect
def aspect_view(aspects: DataFrame) -> DataFrame:
    """d_aspect: one row per distinct (type letter, description), numbered in
    that order (the dense rank of the view, built from distinct keys)."""
    d = aspects.select(S.first_letter_upper("aspect_type_nm").alias("aspect_type_cd"), "aspect_desc").distinct()
    return dense_key(d, ["aspect_type_cd", "aspect_desc"], "aspect_id")


# ------------------------------------------------------------------ D4 f_perf
def perf_view(perfs: DataFrame, events: DataFrame, people: DataFrame) -> DataFrame:
    """f_perf with raw_performance_id and event_id for the next facts.

    Left joins: the event on (competition, program string), skater 1 and
    skater 2 on the name parts (the same person dimension under two roles).
    """
    ev = broadcast_if_small(events.select("event_id", F.col("competition_nm").alias("ev_comp"), "raw_event_nm"))
    people_slim = broadcast_if_small(people.select("person_id", "raw_nm"))
    p1 = people_slim.select(F.col("person_id").alias("skater1_id"), F.col("raw_nm").alias("p1_nm"))
    p2 = people_slim.select(F.col("person_id").alias("skater2_id"), F.col("raw_nm").alias("p2_nm"))
    nm = F.col("skater_nm")
    base = perfs.select(
        "competition_nm", "program_event_nm", "event_perf_seq_nbr", "event_perf_rank_nbr",
        "component_score", "element_score", "deductions",
        F.col("performance_id").alias("raw_performance_id"),
        S.name1(nm).alias("__n1"),
        S.after_slash(nm).alias("__n2"),  # NULL for a single skater: joins nothing, no hot blank key
    )
    j = (base
         .join(ev, (base.competition_nm == ev.ev_comp) & (base.program_event_nm == ev.raw_event_nm), "left")
         .join(p1, F.col("__n1") == p1.p1_nm, "left")
         .join(p2, (F.col("__n2") == p2.p2_nm) & nulls_dealt(base, p2, ["__n2"], ["p2_nm"]), "left"))
    shaped = j.select("event_id", "event_perf_seq_nbr", "skater1_id", "skater2_id", "event_perf_rank_nbr",
                      "component_score", "element_score", "deductions", "raw_performance_id")
    return dense_key(shaped, ["event_id", "event_perf_seq_nbr", "raw_performance_id"], "perf_id")


# ----------------------------------------------------------- D5 f_perf_aspect
def perf_aspect_view(aspects: DataFrame, perf: DataFrame, d_aspect: DataFrame, measures: bool = True) -> DataFrame:
    """f_perf_aspect with raw_judged_aspect_id and the event_id of its
    performance (carried for the score fact).

    The aspect's key takes the place of its texts first, so the texts are not
    shuffled to the performances. Without ``measures`` the rows have their keys
    alone."""
    values = ["base_difficulty", "total_score"] if measures else []
    pk = perf.select("perf_id", "event_id", F.col("raw_performance_id").alias("__raw_perf"))
    da = broadcast_if_small(d_aspect.select("aspect_id", "aspect_type_cd", F.col("aspect_desc").alias("__desc")))
    a = aspects.select(
        "performance_id", "aspect_desc", *values,
        S.round_int("perf_aspect_seq_nbr").alias("perf_aspect_seq_nbr"),
        S.first_letter_upper("aspect_type_nm").alias("__cd"),
        F.col("judged_aspect_id").alias("raw_judged_aspect_id"),
    )
    j = (a.join(da, (a.aspect_desc == da["__desc"]) & (a["__cd"] == da.aspect_type_cd), "left")
         .join(pk, a.performance_id == pk["__raw_perf"], "left"))
    shaped = j.select("perf_id", "perf_aspect_seq_nbr", "aspect_id", *values, "raw_judged_aspect_id", "event_id")
    return dense_key(
        shaped,
        ["perf_id", F.coalesce(F.col("perf_aspect_seq_nbr"), F.lit(0)), "aspect_id", "raw_judged_aspect_id"],
        "perf_aspect_id",
    )


# ----------------------------------------------------- D6 f_perf_aspect_score
def judge_roles(judges: DataFrame, events: DataFrame, people: DataFrame) -> DataFrame:
    """(event_id, clean_role) → judge person_id, one row per event and judge."""
    ev = broadcast_if_small(events.select("event_id", F.col("competition_nm").alias("ev_comp"), "raw_event_nm"))
    pj = people.select(F.col("person_id").alias("judge_id"), F.col("raw_nm").alias("__jnm"))
    j = (judges.join(ev, (judges.competition_nm == ev.ev_comp) & (judges.program_event_nm == ev.raw_event_nm))
         .join(pj, judges.judge_nm == pj["__jnm"], "left"))
    # broadcast to the score rows if the check finds it small
    return broadcast_if_small(j.select(F.col("event_id").alias("__ev"), F.col("clean_role").alias("__role"),
                                       "judge_id"))


def perf_aspect_score_view(scores: DataFrame, perf_aspect: DataFrame, roles: DataFrame) -> DataFrame:
    pa = perf_aspect.select("perf_aspect_id", "event_id", F.col("raw_judged_aspect_id").alias("__raw_asp"))
    j = (scores.join(pa, scores.judged_aspect_id == pa["__raw_asp"], "left")
         .join(roles, (pa["event_id"] == roles["__ev"]) & (scores.clean_role == roles["__role"]), "left"))
    shaped = j.select("perf_aspect_id", "judge_id", "score")
    return dense_key(shaped, ["perf_aspect_id", "judge_id", "score"], "perf_aspect_score_id")


# ------------------------------------------------------------------ assembly
@dataclass
class StarModel:
    d_event: DataFrame
    d_person: DataFrame
    d_aspect: DataFrame
    f_perf: DataFrame
    f_perf_aspect: DataFrame
    f_perf_aspect_score: DataFrame

    def tables_partial(self, name: str) -> DataFrame:
        """One table with its load columns (the raw keys left out)."""
        return getattr(self, name).select(*columns_of(name))

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: self.tables_partial(f.name) for f in fields(self)}


def build_model(spark: SparkSession, sf_dir: str, upto: str = "f_perf_aspect_score",
                materialize_staging: bool = True, measures: bool = True) -> StarModel:
    """Build the model up to ``upto`` (later tables are left as None).

    Only the staging tables the requested tables need are derived. A staging
    table that more than one step reads (performances from f_perf on, judged
    aspects from f_perf_aspect on) is written once as parquet under the shared
    checkpoint directory instead of being derived again per step. Without
    ``measures`` the aspect fact, where it is but a step to the scores, carries
    its keys alone.
    """
    deps = {"d_event": [], "d_person": [], "d_aspect": [], "f_perf": ["d_event", "d_person"],
            "f_perf_aspect": ["f_perf", "d_aspect"], "f_perf_aspect_score": ["f_perf_aspect", "d_event", "d_person"]}
    need: set[str] = set()

    def add(t: str) -> None:
        if t not in need:
            need.add(t)
            for d in deps[t]:
                add(d)

    add(upto)
    perfs = aspects = judges = scores = None
    if need & {"d_event", "d_person", "f_perf"}:
        perfs = stg.s_performances(spark, sf_dir)
        if materialize_staging and "f_perf" in need:
            perfs = materialize(perfs, "s_performances")
    if need & {"d_person", "f_perf_aspect_score"}:
        judges = stg.s_judges(spark, sf_dir, perfs)
        if materialize_staging:  # read by the range sample and the shuffle of d_person, and by the judge roles
            judges = materialize(judges, "s_judges")
    if need & {"d_aspect", "f_perf_aspect"}:
        aspects = stg.s_judged_aspects(spark, sf_dir)
        if materialize_staging and "f_perf_aspect" in need:
            aspects = materialize(aspects, "s_judged_aspects", "zstd")
    if "f_perf_aspect_score" in need:
        scores = stg.s_judge_scores(spark, sf_dir, aspects)

    ev = event_view(perfs) if "d_event" in need else None
    pe = person_view(perfs, judges) if "d_person" in need else None
    da = aspect_view(aspects) if "d_aspect" in need else None
    fp = perf_view(perfs, ev, pe) if "f_perf" in need else None
    fpa = None
    if "f_perf_aspect" in need:
        fpa = perf_aspect_view(aspects, fp, da, measures or upto == "f_perf_aspect")
    fpas = None
    if "f_perf_aspect_score" in need:
        fpas = perf_aspect_score_view(scores, fpa, judge_roles(judges, ev, pe))
    return StarModel(ev, pe, da, fp, fpa, fpas)
