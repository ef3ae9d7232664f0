"""Oracle SQL (DuckDB dialect) for the model tables and shared SQL fragments.

The driver runs these next to the Spark queries on the same parquet tables.
Rules (SURVEY §7.3): ``NULLS FIRST`` in every window order, ``round`` before a
cast to bigint, row numbers cast to bigint, every column aliased.
"""

from __future__ import annotations

from .staging import with_staging


def d_initcap(x: str) -> str:
    """INITCAP by words of spaces, hyphens, apostrophes (DuckDB)."""
    return ("array_to_string(list_transform(regexp_extract_all({x}, '( +|-+|''+|.[^ ''-]*)'), "
            "lambda w: upper(w[1]) || lower(w[2:])), '')").format(x=x)


def d_cut(nm: str) -> str:
    """Position of the capital before the first a-z after the first word."""
    probe = f"(upper(split_part({nm}, ' ', 1)) || substr({nm}, instr({nm}, ' ')))"
    q = f"instr(regexp_replace({probe}, '[a-z]', 'x', 'g'), 'x')"
    return f"(case when instr({nm}, ' ') > 0 and {q} > 1 then {q} - 1 else 0 end)"


def d_surname(nm: str) -> str:
    p = d_cut(nm)
    return d_initcap(f"(case when {p} > 0 then trim(substr({nm}, 1, greatest({p} - 2, 0))) else {nm} end)")


def d_forename(nm: str) -> str:
    p = d_cut(nm)
    return d_initcap(f"(case when {p} > 0 then trim(substr({nm}, {p})) end)")


def d_element(pe: str) -> str:
    a = f"string_split({pe}, ' ')"
    return f"(case when len({a}) >= 2 then {a}[-2] || ' ' || {a}[-1] end)"


def d_program(pe: str) -> str:
    el = d_element(pe)
    head = f"(case when {el} is not null then substr({pe}, 1, length({pe}) - length({el})) else {pe} end)"
    return f"rtrim(trim({head}), ' -')"


def d_name1(nm: str) -> str:
    return f"trim(split_part({nm}, '/', 1))"


def d_name2(nm: str) -> str:
    return f"(case when instr({nm}, '/') > 0 then trim(trim(substr({nm}, instr({nm}, '/')), '/')) end)"


def d_title(x: str) -> str:
    """Python-style title case: capital after every non-letter (DuckDB)."""
    return ("array_to_string(list_transform(regexp_extract_all({x}, '(\\p{{L}}+|\\P{{L}}+)'), "
            "lambda w: upper(w[1]) || lower(w[2:])), '')").format(x=x)


def d_trunc(x: str) -> str:
    """Text to a whole number toward zero, blank or NULL -> 0 (DuckDB)."""
    return (f"(case when coalesce(cast({x} as varchar), '') = '' then cast(0 as bigint) "
            f"else cast(trunc(cast(cast({x} as varchar) as double)) as bigint) end)")


def d_row_number(*order: str) -> str:
    cols = ", ".join(f"{o} nulls first" for o in order)
    return f"cast(row_number() over (order by {cols}) as bigint)"


# ----------------------------------------------------------------- model CTEs
EVENT_V = f"""
event_v as (
  select {d_row_number('competition_nm', 'program_nm', 'element_nm', 'raw_event_nm')} as event_id, *
  from (select competition_nm,
               {d_program('program_event_nm')} as program_nm,
               {d_element('program_event_nm')} as element_nm,
               count(*) as entries_ct,
               program_event_nm as raw_event_nm
        from s_performances group by competition_nm, program_event_nm) g)
"""

# People: each performance names up to four (ladies, men, and the two sides of
# the slash), kept where their condition holds; judges come without a gender.
RAW_PEOPLE = """
raw_people as (
  select nationality, named.gender, named.nm
  from (select nationality, unnest([
          {'holds': program_event_nm like '%Ladies%', 'gender': 'F', 'nm': skater_nm},
          {'holds': program_event_nm like '%Men%', 'gender': 'M', 'nm': skater_nm},
          {'holds': instr(skater_nm, '/') > 0, 'gender': 'F', 'nm': trim(left(skater_nm, greatest(instr(skater_nm, '/') - 1, 0)))},
          {'holds': instr(skater_nm, '/') > 0, 'gender': 'M', 'nm': trim(right(skater_nm, -instr(skater_nm, '/')))}
        ]) as named from s_performances)
  where named.holds
  union
  select nationality, null, judge_nm from s_judges)
"""

PERSON_V = RAW_PEOPLE.rstrip() + f""",
people as (
  select {d_forename('nm')} as forename, {d_surname('nm')} as surname, gender, nationality, nm as raw_nm
  from raw_people),
person_v as (
  select {d_row_number('surname', 'forename', 'nationality', 'gender', 'raw_nm')} as person_id, *
  from people)
"""

ASPECT_V = f"""
aspect_v as (
  select {d_row_number('aspect_type_cd', 'aspect_desc')} as aspect_id, aspect_type_cd, aspect_desc
  from (select distinct upper(substr(aspect_type_nm, 1, 1)) as aspect_type_cd, aspect_desc
        from s_judged_aspects) d)
"""

# Facts: names are resolved through one map (name → person), and the aspect fact
# carries its event, so a score meets (event, role) → judge directly.
PERF_V = f"""
person_by_name as (select raw_nm, person_id from person_v),
perf_v as (
  with entry as (
    select *, {d_name1('skater_nm')} as lead_nm, {d_name2('skater_nm')} as partner_nm from s_performances)
  select {d_row_number('event_id', 'event_perf_seq_nbr', 'raw_performance_id')} as perf_id, *
  from (select ev.event_id, entry.event_perf_seq_nbr, lead.person_id as skater1_id, partner.person_id as skater2_id,
               entry.event_perf_rank_nbr, entry.component_score, entry.element_score, entry.deductions,
               entry.performance_id as raw_performance_id
        from entry
        left join event_v ev on ev.raw_event_nm = entry.program_event_nm and ev.competition_nm = entry.competition_nm
        left join person_by_name lead on lead.raw_nm = entry.lead_nm
        left join person_by_name partner on partner.raw_nm = entry.partner_nm) resolved)
"""

PERF_ASPECT_V = f"""
perf_aspect_v as (
  with shaped as (
    select judged_aspect_id as raw_judged_aspect_id, performance_id, upper(aspect_type_nm[1]) as aspect_type_cd,
           aspect_desc, cast(round(perf_aspect_seq_nbr) as bigint) as perf_aspect_seq_nbr, base_difficulty, total_score
    from s_judged_aspects)
  select {d_row_number('perf_id', 'coalesce(perf_aspect_seq_nbr, 0)', 'aspect_id', 'raw_judged_aspect_id')}
         as perf_aspect_id, *
  from (select perf.perf_id, perf.event_id, kind.aspect_id, shaped.* exclude (performance_id, aspect_type_cd, aspect_desc)
        from shaped
        left join aspect_v kind using (aspect_type_cd, aspect_desc)
        left join perf_v perf on perf.raw_performance_id = shaped.performance_id) resolved)
"""

SCORE_V = f"""
judge_by_role as (
  select ev.event_id, j.clean_role, known.person_id as judge_id
  from event_v ev
  join s_judges j on j.program_event_nm = ev.raw_event_nm and j.competition_nm = ev.competition_nm
  left join person_by_name known on known.raw_nm = j.judge_nm),
score_v as (
  select {d_row_number('perf_aspect_id', 'judge_id', 'score')} as perf_aspect_score_id, perf_aspect_id, judge_id, score
  from s_judge_scores given
  left join (select raw_judged_aspect_id as judged_aspect_id, perf_aspect_id, event_id from perf_aspect_v) asp
    using (judged_aspect_id)
  left join judge_by_role using (event_id, clean_role))
"""


def model_sql(ctes: list[str], select: str, staging: list[str]) -> str:
    body = "with " + ",\n".join(c.strip() for c in ctes) + "\n" + select
    # merge the staging CTEs in front of the model CTEs
    st = with_staging("select 1", *staging)
    head = st[: st.rindex("\nselect 1")]
    return head + ",\n" + body[len("with "):]


MODEL_ORACLE = {
    "d_event": model_sql(
        [EVENT_V],
        "select event_id, competition_nm, program_nm, element_nm, entries_ct from event_v",
        ["s_performances"]),
    "d_person": model_sql(
        [PERSON_V],
        "select person_id, forename, surname, gender, nationality from person_v",
        ["s_performances", "s_judges"]),
    "d_aspect": model_sql(
        [ASPECT_V],
        "select aspect_id, aspect_type_cd, aspect_desc from aspect_v",
        ["s_judged_aspects"]),
    "f_perf": model_sql(
        [EVENT_V, PERSON_V, PERF_V],
        "select perf_id, event_id, event_perf_seq_nbr, skater1_id, skater2_id, event_perf_rank_nbr, "
        "component_score, element_score, deductions from perf_v",
        ["s_performances", "s_judges"]),
    "f_perf_aspect": model_sql(
        [EVENT_V, PERSON_V, PERF_V, ASPECT_V, PERF_ASPECT_V],
        "select perf_aspect_id, perf_id, perf_aspect_seq_nbr, aspect_id, base_difficulty, total_score "
        "from perf_aspect_v",
        ["s_performances", "s_judges", "s_judged_aspects"]),
    "f_perf_aspect_score": model_sql(
        [EVENT_V, PERSON_V, PERF_V, ASPECT_V, PERF_ASPECT_V, SCORE_V],
        "select perf_aspect_score_id, perf_aspect_id, judge_id, score from score_v",
        ["s_performances", "s_judges", "s_judged_aspects", "s_judge_scores"]),
}
