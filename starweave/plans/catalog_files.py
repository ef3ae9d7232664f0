"""Queries for the delimited-files route.

Each query writes the staging tables as the four CSV source files, runs the
positional files route up to one output, writes that output as pipe-delimited
text, and reads it back typed. The oracles give the same rows with the route's
own rules (SURVEY §2.12): events come from the judges, entries count distinct
performance ids, a person found by name takes the smallest key, aspects are
keyed by type letter and description, and a whole-number aspect sequence of 0
is written blank.
"""

from __future__ import annotations

from ..session import scratch_path, shuffles_dropped
from ..sources import text as TX
from . import routes as RT
from .catalog import register
from .oracle import d_element, d_forename, d_name1, d_name2, d_program, d_row_number, d_surname, d_title, d_trunc
from .staging import with_staging

_CTES = {
    "f_entries": """
f_entries as (
  select competition_nm as comp, program_event_nm as prog, count(*) as entries
  from (select distinct competition_nm, program_event_nm, performance_id from s_performances) d
  group by competition_nm, program_event_nm)""",
    "f_ev": f"""
f_ev as (
  select {d_row_number('e.comp', 'e.prog')} as event_id, e.comp, e.prog, n.entries
  from (select distinct competition_nm as comp, program_event_nm as prog from s_judges) e
  left join f_entries n on e.comp = n.comp and e.prog = n.prog)""",
    "f_pers": f"""
f_sk as (
  select {d_name1('skater_nm')} as n1, {d_name2('skater_nm')} as n2,
         case when instr({d_title('program_event_nm')}, 'Men ') > 0 then 'M' else 'F' end as g1,
         case when instr(skater_nm, '/') > 0 then 'M' end as g2,
         nationality as ctry
  from s_performances),
f_people as (
  select distinct nm, fore, sur, gender, ctry from (
    select n1 as nm, {d_forename('n1')} as fore, {d_surname('n1')} as sur, g1 as gender, ctry from f_sk
    union all
    select n2, {d_forename('n2')}, {d_surname('n2')}, g2, ctry from f_sk) u
  where coalesce(nm, '') <> '' or coalesce(fore, '') <> '' or coalesce(sur, '') <> ''
        or coalesce(gender, '') <> ''),
f_judges as (
  select nm, {d_forename('nm')} as fore, {d_surname('nm')} as sur, cast(null as varchar) as gender, ctry
  from (select distinct judge_nm as nm, nationality as ctry from s_judges) j),
f_pers as (
  select {d_row_number('sur', 'fore', 'ctry', 'gender', 'nm')} as person_id, nm, fore, sur, gender, ctry
  from (select * from f_people union all select * from f_judges) a),
f_pmin as (select nm, min(person_id) as person_id from f_pers group by nm)""",
    "f_perf": f"""
f_perf as (
  select {d_row_number('event_id', 'seq', 'pid')} as performance_id, *
  from (select distinct p.performance_id as pid, p.event_perf_rank_nbr as rank, p.event_perf_seq_nbr as seq,
               p.element_score as el, p.component_score as co, p.deductions as ded, ev.event_id,
               a.person_id as sk1, b.person_id as sk2
        from s_performances p
        left join f_ev ev on p.competition_nm = ev.comp and p.program_event_nm = ev.prog
        left join f_pmin a on {d_name1('p.skater_nm')} = a.nm
        left join f_pmin b on {d_name2('p.skater_nm')} = b.nm) x)""",
    "f_asp": f"""
f_shaped as (
  select distinct judged_aspect_id as ja, performance_id as pid, upper(substr(aspect_type_nm, 1, 1)) as letter,
         aspect_desc as descr, {d_trunc('perf_aspect_seq_nbr')} as seq, base_difficulty as bdiff,
         total_score as score
  from s_judged_aspects),
f_asp as (
  select {d_row_number('letter', 'descr')} as aspect_id, letter, descr
  from (select distinct letter, descr from f_shaped) d)""",
    "f_pa": f"""
f_pa as (
  select {d_row_number('perf_sk', 'seq', 'aspect_id', 'ja')} as pa_id, *
  from (select shaped.ja, shaped.seq, shaped.bdiff, shaped.score, pf.performance_id as perf_sk, asp.aspect_id
        from f_shaped shaped
        left join f_perf pf on shaped.pid = pf.pid
        left join f_asp asp on shaped.letter = asp.letter and shaped.descr = asp.descr) x)""",
    "f_sc": f"""
f_role_persons as (
  select j.clean_role as role, pr.person_id, ev.event_id
  from s_judges j
  left join f_pers pr on j.judge_nm = pr.nm
  left join f_ev ev on j.competition_nm = ev.comp and j.program_event_nm = ev.prog),
f_role_judge as (select event_id, role, min(person_id) as person_id from f_role_persons group by event_id, role),
f_sc as (
  select pa.pa_id, r.person_id, sc.score
  from (select distinct judged_aspect_id as ja, clean_role as role, score from s_judge_scores) sc
  left join f_pa pa on sc.ja = pa.ja
  left join f_perf pf on pa.perf_sk = pf.performance_id
  left join f_role_judge r on pf.event_id = r.event_id and sc.role = r.role)""",
}

_NEEDS = {
    "d_person": ["f_pers"],
    "d_event": ["f_entries", "f_ev"],
    "d_aspect": ["f_asp"],
    "f_perf": ["f_entries", "f_ev", "f_pers", "f_perf"],
    "f_perf_aspect": ["f_entries", "f_ev", "f_pers", "f_perf", "f_asp", "f_pa"],
    "f_perf_aspect_score": ["f_entries", "f_ev", "f_pers", "f_perf", "f_asp", "f_pa", "f_sc"],
}

_SELECT = {
    "d_person": "select person_id, fore as forename, sur as surname, gender, ctry as nationality from f_pers",
    "d_event": f"""select event_id, comp as competition_nm, {d_program('prog')} as program_nm,
       {d_element('prog')} as element_nm, entries as entries_ct from f_ev""",
    "d_aspect": "select aspect_id, letter as aspect_type_cd, descr as aspect_desc from f_asp",
    "f_perf": """select performance_id as perf_id, event_id, seq as event_perf_seq_nbr, sk1 as skater1_id,
       sk2 as skater2_id, rank as event_perf_rank_nbr, co as component_score, el as element_score,
       ded as deductions from f_perf""",
    "f_perf_aspect": """select pa_id as perf_aspect_id, perf_sk as perf_id, nullif(seq, 0) as perf_aspect_seq_nbr,
       aspect_id, bdiff as base_difficulty, score as total_score from f_pa""",
    "f_perf_aspect_score": f"""select {d_row_number('pa_id', 'person_id', 'score')} as perf_aspect_score_id,
       pa_id as perf_aspect_id, person_id as judge_id, score from f_sc""",
}


def _oracle(name: str) -> str:
    staged = with_staging("select 1", *RT.FILES_SOURCES[name])
    head = staged[: staged.rindex("\nselect 1")]
    ctes = ",".join(_CTES[c] for c in _NEEDS[name])
    return f"{head},{ctes}\n{_SELECT[name]}"


def _files_query(name: str):
    def run(spark, sf):
        base = scratch_path(spark, "files_route")
        out = f"{base}/{RT.OUTPUT_FILES[name]}"
        with shuffles_dropped(spark):  # each step is written, and its shuffles are not needed then
            RT.export_source_csv(spark, sf, f"{base}/csv", only=RT.FILES_SOURCES[name])
            df = RT.files_route_tables(spark, f"{base}/csv", only=[name])[name]
            TX.write_text(df, out, "|")
        return RT.read_files_output(spark, out, name)

    run.__name__ = f"q_files_{name}"
    return run


for _name in RT.FILES_COLUMNS:
    register(f"files_{_name}", _oracle(_name))(_files_query(_name))
