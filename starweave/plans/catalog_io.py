"""Queries for sources, sinks, loads and streams.

Each writes what the driver's tables (or staging derived from them) hold to
a fresh location under the shared checkpoint directory or to a new catalog
table, reads it back, and returns what was read, so the oracle can compare
it with the source rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.scalars import INITCAP_SQL_BODY
from ..operators import keys as K
from ..operators.reshape import fan_out
from ..session import read_table, scratch_path, shuffles_dropped
from ..sources import objects as OB
from ..sources import schemas as SC
from ..sources import tables as TB
from ..sources import text as TX
from ..streaming import drain as D
from ..streaming import publish as PB
from ..streaming import pull as PL
from . import model as M
from . import staging as stg
from .catalog import register
from .oracle import MODEL_ORACLE, d_initcap
from .staging import with_staging


def _table_name(kind: str) -> str:
    return f"sw_{kind}_{uuid.uuid4().hex[:10]}"


# ------------------------------------------------------------- O4, O5, O6
@register("switch_delimiters", """
select p_partkey, cast(p_partkey as varchar) || '|' || p_name || ' q, x|' || p_brand || '|'
       || cast(p_size as varchar) as line
from part""")
def q_switch_delimiters(spark, sf):
    # A CSV line with a quoted field holding the old delimiter and doubled
    # quotes, and a blank before a field.
    p = read_table(spark, sf, "part")
    line = F.concat(p.p_partkey.cast("string"), F.lit(',"'), p.p_name, F.lit(' ""q"", x", '), p.p_brand,
                    F.lit(","), p.p_size.cast("string"))
    return p.select("p_partkey", TX.switch_delimiters(line, ",", "|").alias("line"))


@register("convert_rec", """
select cast(p_partkey as varchar) as f0, p_name as f1, p_brand as f2, cast(p_size as varchar) as f3,
       nullif(p_type, '') as f4
from part""")
def q_convert_rec(spark, sf):
    p = read_table(spark, sf, "part")
    lines = p.select(TX.rec_to_text([p.p_partkey, p.p_name, p.p_brand, p.p_size, p.p_type], "|").alias("line"))
    return TX.rec_fields(lines, "line", "|", ["f0", "f1", "f2", "f3", "f4"])


@register("rec_to_text", with_staging("""
select judged_aspect_id || '|' || aspect_type_nm || '|' || coalesce(cast(cast(perf_aspect_seq_nbr as bigint) as varchar), '')
       || '|' || coalesce(info_flag, '') || '|' || aspect_desc as value
from s_judged_aspects""", "s_judged_aspects"))
def q_rec_to_text(spark, sf):
    a = stg.s_judged_aspects(spark, sf)
    return a.select(TX.rec_to_text([a.judged_aspect_id, a.aspect_type_nm, a.perf_aspect_seq_nbr.cast("bigint"),
                                    a.info_flag, a.aspect_desc], "|").alias("value"))


# ----------------------------------------------------------- O1, O2, O3, O7
@register("csv_import", with_staging("select * from s_performances", "s_performances"))
def q_csv_import(spark, sf):
    path = scratch_path(spark, "csv_import")
    TX.write_csv(stg.s_performances(spark, sf), path)
    return SC.conform(TX.read_csv(spark, path, SC.SCHEMAS["s_performances"]), "s_performances")


@register("csv_import_quoted", "select doc_id, text, lang, source, n_chars from documents")
def q_csv_import_quoted(spark, sf):
    # Texts with newlines, quotes and commas, written as CSV and imported in splits into an existing table.
    docs = read_table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path, t = scratch_path(spark, "csv_quoted"), _table_name("documents")
    TX.write_csv(docs, path, quote_all=True)
    TB.create_table(spark, t, docs.schema)
    TB.import_csv(spark, t, path)
    return spark.table(t)


@register("read_lines", with_staging("""
select performance_id, competition_nm, program_event_nm, skater_nm, nationality from s_performances""",
                                     "s_performances"))
def q_read_lines(spark, sf):
    # The files route: lines with a header, re-delimited, split by position.
    path = scratch_path(spark, "lines")
    p = stg.s_performances(spark, sf).select("performance_id", "competition_nm", "program_event_nm",
                                             "skater_nm", "nationality")
    TX.write_csv(p, path)
    lines = TX.read_lines(spark, path, skip_header=True)
    switched = lines.select(TX.switch_delimiters(F.col("line"), ",", "|").alias("line"))
    return TX.rec_fields(switched, "line", "|", p.columns)


@register("text_sink", MODEL_ORACLE["d_person"].replace(
    "select person_id, forename, surname, gender, nationality from person_v",
    "select cast(person_id as varchar) as person_id, forename, surname, gender, nationality from person_v"))
def q_text_sink(spark, sf):
    path = scratch_path(spark, "text_sink")
    person = M.build_model(spark, sf, "d_person").tables_partial("d_person")
    TX.write_text(person, path, "|")
    return TX.read_text_table(spark, path, person.columns, "|")


@register("text_one_file", """
select cast(o_orderkey as varchar) as o_orderkey, o_orderstatus, o_orderpriority,
       cast(row_number() over (order by o_orderkey) as varchar) as line_no from orders""")
def q_text_one_file(spark, sf):
    # One file of a given name, its lines in order, written by many tasks.
    path = f"{scratch_path(spark, 'one_file')}/orders.dat"
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    keyed = K.dense_key(o, ["o_orderkey"], "line_no", first=False)
    TX.write_text(keyed.repartitionByRange("line_no").sortWithinPartitions("line_no"), path, "|", single_file=True)
    return TX.read_text_table(spark, path, keyed.columns, "|")


@register("schema_check", with_staging("select * from s_judged_aspects", "s_judged_aspects"))
def q_schema_check(spark, sf):
    return SC.conform(stg.s_judged_aspects(spark, sf), "s_judged_aspects")


# ------------------------------------------------------------- O8 - O12, X2
@register("load_overwrite", MODEL_ORACLE["d_event"])
def q_load_overwrite(spark, sf):
    t = _table_name("d_event")
    TB.create_table(spark, t, SC.SCHEMAS["d_event"])
    ev = M.build_model(spark, sf, "d_event").d_event
    cols = SC.columns_of("d_event")
    TB.load_overwrite(ev.filter(F.col("entries_ct") > 0), t, cols)  # a first load ...
    TB.load_overwrite(ev, t, cols)  # ... replaced whole by the second
    return spark.table(t)


@register("load_empty", MODEL_ORACLE["d_person"])
def q_load_empty(spark, sf):
    t = _table_name("d_person")
    TB.create_table(spark, t, SC.SCHEMAS["d_person"])
    TB.truncate(spark, t)
    person = M.build_model(spark, sf, "d_person").d_person
    TB.load_if_empty(person, t, SC.columns_of("d_person"))
    return spark.table(t)


@register("truncate_insert", MODEL_ORACLE["d_aspect"])
def q_truncate_insert(spark, sf):
    t = _table_name("d_aspect")
    TB.create_table(spark, t, SC.SCHEMAS["d_aspect"])
    da = M.build_model(spark, sf, "d_aspect").tables_partial("d_aspect")
    TB.load_overwrite(da, t)
    TB.truncate(spark, t)
    TB.load_if_empty(da, t)  # empty after the truncate, so it loads
    return spark.table(t)


@register("load_proc", MODEL_ORACLE["d_aspect"])
def q_load_proc(spark, sf):
    t = _table_name("d_aspect")
    TB.create_table(spark, t, SC.SCHEMAS["d_aspect"])
    TB.load_procedure(spark, t, M.build_model(spark, sf, "d_aspect").tables_partial("d_aspect"))
    return spark.table(t)


@register("replace_table", MODEL_ORACLE["d_aspect"])
def q_replace_table(spark, sf):
    # O12 for tables: a table of another shape is replaced, then loaded.
    t = _table_name("d_aspect")
    TB.create_table(spark, t, SC.SCHEMAS["d_event"])
    TB.create_table(spark, t, SC.SCHEMAS["d_aspect"], replace=True)
    TB.load_if_empty(M.build_model(spark, sf, "d_aspect").tables_partial("d_aspect"), t)
    return spark.table(t)


@register("sql_udf", with_staging(f"""
select performance_id, {d_initcap('skater_nm')} as skater_cap from s_performances""", "s_performances"))
def q_sql_udf(spark, sf):
    TB.replace_function(spark, "initcap_words")
    view = _table_name("perf_v")
    TB.replace_view(stg.s_performances(spark, sf), view)
    return spark.sql(f"select performance_id, initcap_words(skater_nm) as skater_cap from {view}")


@register("define_objects", f"""
select p_partkey, p_name, {d_initcap('p_name')} as name_cap from part""")
def q_define_objects(spark, sf):
    # A table, a function and a view that the catalog keeps; equal definitions leave them, and the rows, alone.
    t, f, v = _table_name("part"), f"default.{_table_name('cap')}", _table_name("part_v")
    p = read_table(spark, sf, "part").select("p_partkey", "p_name")
    OB.define_table(spark, t, p.schema)
    TB.load_procedure(spark, t, p)
    function = (spark, f, [("str", "STRING")], "STRING", INITCAP_SQL_BODY)
    view = (spark, v, f"select p_partkey, p_name, {f}(p_name) as name_cap from {t}")
    OB.define_function(*function)
    OB.define_view(*view)
    again = OB.define_table(spark, t, p.schema), OB.define_function(*function), OB.define_view(*view)
    assert again == ("kept",) * 3, again
    return spark.table(v)


@register("fan_out", with_staging("""
select a.aspect_type_nm, a.n_aspects, b.n_performances
from (select aspect_type_nm, count(*) as n_aspects from s_judged_aspects group by aspect_type_nm) a
join (select aspect_type_nm, count(distinct performance_id) as n_performances from s_judged_aspects
      group by aspect_type_nm) b on a.aspect_type_nm = b.aspect_type_nm""", "s_judged_aspects"))
def q_fan_out(spark, sf):
    a = stg.s_judged_aspects(spark, sf).select("aspect_type_nm", "performance_id")
    x1, x2 = fan_out(a, 2)
    n1 = x1.groupBy("aspect_type_nm").agg(F.count(F.lit(1)).alias("n_aspects"))
    n2 = (x2.select("aspect_type_nm", "performance_id").distinct().groupBy("aspect_type_nm")
          .agg(F.count(F.lit(1)).alias("n_performances")))
    return n1.join(n2, "aspect_type_nm")


@register("warehouse_route", MODEL_ORACLE["f_perf_aspect_score"])
def q_warehouse_route(spark, sf):
    # The whole warehouse job: CSV import into existing staging tables, then
    # every model table loaded with its own load mode; the score fact is read
    # back from its table.
    from . import routes as RT

    csv_dir = scratch_path(spark, "warehouse_csv")
    with shuffles_dropped(spark):
        RT.export_source_csv(spark, sf, csv_dir)
    tables = RT.run_warehouse_route(spark, csv_dir, _table_name("wh"))
    return spark.table(tables["f_perf_aspect_score"])


# ------------------------------------------------------------------ M1 - M3
def _events_stream(spark, sf):
    schema = read_table(spark, sf, "events").schema
    return D.message_stream(spark, sf, schema, fmt="parquet", glob="events.parquet")


@register("drain_messages", "select * from events")
def q_drain_messages(spark, sf):
    sink, ckpt = scratch_path(spark, "drain_sink"), scratch_path(spark, "drain_ckpt")
    D.drain(_events_stream(spark, sf), sink, ckpt)
    D.drain(_events_stream(spark, sf), sink, ckpt)  # same checkpoint: nothing is delivered twice
    return spark.read.parquet(sink)


@register("capped_pull", """
select *, (row_number() over (order by event_id) - 1) // 1000 as pull_no from events""")
def q_capped_pull(spark, sf):
    # Pulls of 1000 messages: each micro-batch is dealt into numbered pulls.
    sink, ckpt = scratch_path(spark, "pull_sink"), scratch_path(spark, "pull_ckpt")

    def write(batch, batch_id):
        D.capped_pulls(batch, 1000, ["event_id"]).write.mode("append").parquet(sink)

    q = (_events_stream(spark, sf).writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink)


@register("publish_rows", """
select cast(event_id as varchar) || '|' || cast(user_id as varchar) || '|' || event_type as value, 'Y' as reply
from events""")
def q_publish_rows(spark, sf):
    sink = scratch_path(spark, "publish_sink")
    ev = read_table(spark, sf, "events")

    def payload(df):
        return df.select(F.encode(TX.rec_to_text([df.event_id, df.user_id, df.event_type], "|"), "UTF-8")
                         .alias("value"))

    def deliver(batch, batch_id):
        batch.write.mode("append").parquet(sink)

    results = D.publish(ev, payload, sink=deliver)
    reply = results[0].reply if results else "N"
    return spark.read.parquet(sink).select(F.decode("value", "UTF-8").alias("value"), F.lit(reply).alias("reply"))


@register("pull_batches", """
select *, (row_number() over (order by c_custkey) - 1) // 1000 as pull_no from customer""")
def q_pull_batches(spark, sf):
    # The stream itself is capped by messages: each micro-batch is one pull of 1000.
    sink, ckpt = scratch_path(spark, "pulls_sink"), scratch_path(spark, "pulls_ckpt")
    schema = read_table(spark, sf, "customer").schema
    stream = PL.pull_stream(spark, f"{sf}/customer.parquet", schema, limit=1000)

    def write(batch, number):
        batch.withColumn("pull_no", F.lit(number).cast("long")).write.mode("append").parquet(sink)

    PL.pull(stream, write, ckpt)
    PL.pull(stream, write, ckpt)  # same checkpoint: nothing is pulled twice
    return spark.read.parquet(sink)


@register("publish_each", """
select cast(event_id as varchar) || '|' || event_type as value, 1::bigint as delivered, 'Y' as reply,
       case when event_id % 10 = 3 then 2 else 1 end::bigint as attempt
from events""")
def q_publish_each(spark, sf):
    # A sink that refuses some messages at first: the retry sends only those, so each is delivered once.
    path, ledger = scratch_path(spark, "topic").removeprefix("file:"), scratch_path(spark, "ledger")

    def payload(df):
        return df.select(F.encode(TX.rec_to_text([df.event_id, df.event_type], "|"), "UTF-8").alias("value"))

    ev = read_table(spark, sf, "events")
    PB.publish_each(ev, _refusing(path, b"3"), ledger, payload=payload)
    told = PB.publish_each(ev, PB.folder_sink(path), ledger, payload=payload)
    got = spark.read.text(path).groupBy("value").agg(F.count(F.lit(1)).alias("delivered"))
    sent = told.join(PB.messages(spark, ledger), ["batch", "message"]).select(
        F.decode("value", "UTF-8").alias("value"), "reply", "attempt")
    return sent.join(got, "value").select("value", "delivered", "reply", "attempt")


def _refusing(path, last):
    """A folder sink that refuses messages whose id ends with ``last``."""
    from contextlib import contextmanager

    inner = PB.folder_sink(path)

    @contextmanager
    def opened():
        with inner() as send:

            def some(value, key):
                if value.split(b"|")[0].endswith(last):
                    raise ConnectionError("refused")
                return send(value, key)

            yield some

    return opened
