"""Report tables, context rows, report text and run figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.functions import markup
from flowgauge.operators import confusion as ops
from flowgauge.params import QUALITY_BANDS, QUALITY_REST, SCORE_BANDS, SCORE_REST, VOLUME_BANDS, VOLUME_REST
from flowgauge.plans import report_text, reports, runlog
from flowgauge.registry import views as v
from flowgauge.registry.entry import query
from flowgauge.registry.sql import bands, sql_markup, sql_strip, with_views
from flowgauge.sources.tables import read_report, read_table, report_dir, write_reports

_TARGET = v.REPORT.target_score
_MANY_MISSED = 200
_CHOSEN = f"label = '{v.CHOICE}' as selected"


def _kpis(report: v.Report) -> DataFrame:
    return reports.kpi_summary(report.counts, report.per_class, report.metrics, v.REPORT)


@query("kpi_summary", with_views("select * from kpis", "kpis"))
def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kpis(v.Report(spark, sf_dir))


@query(
    "worst_class",
    with_views('select label, f1, "precision", recall, fn from per_class order by f1, label_index limit 1', "per_class"),
)
def worst_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.worst_class(v.Report(spark, sf_dir).per_class)


@query(
    "volume_bands",
    with_views(
        f"""select label, "count", {bands("share", VOLUME_BANDS, VOLUME_REST, ">")} as band, {_CHOSEN}
            from (select label, "count", "count"::double / max("count") over () as share
                  from classes where label <> 'benign')""",
        "classes",
    ),
)
def volume_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.volume_bands(v.classes(spark, sf_dir).select("label", "count"), v.REPORT, v.CHOICE)


@query(
    "metric_bands",
    with_views(
        " union all ".join(
            f"""select '{m}' as metric, label, "{m}" as value, {bands(f'"{m}"', SCORE_BANDS, SCORE_REST, ">=")} as band,
                       "{m}" < {_TARGET} as below_target,
                       greatest(0.0, min("{m}") over () - {v.REPORT.axis_margin})::double as axis_floor, {_CHOSEN}
                from per_class"""
            for m in ("f1", "precision", "recall")
        ),
        "per_class",
    ),
)
def metric_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_class = v.Report(spark, sf_dir).per_class
    parts = [
        reports.metric_bands(per_class, v.REPORT, m, v.CHOICE).select(F.lit(m).alias("metric"), "*")
        for m in ("f1", "precision", "recall")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "pr_points",
    with_views(
        f"""select label, "precision", recall, f1, fn, volume,
                   round({v.REPORT.min_point} + {v.REPORT.point_range} * (volume::double / max(volume) over ()), 6)::double as size,
                   {bands("f1", SCORE_BANDS, SCORE_REST, ">=")} as band,
                   "precision" >= {_TARGET} and recall >= {_TARGET} as ideal, {_CHOSEN}
            from (select p.*, coalesce(c."count", {v.REPORT.default_volume}) as volume
                  from per_class p left join classes c using (label))""",
        "per_class",
    ),
)
def pr_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = v.Report(spark, sf_dir)
    return reports.pr_points(report.per_class, report.counts, v.REPORT, v.CHOICE)


@query(
    "confusion_heat",
    with_views(
        """select coalesce(ac.label, a::int::varchar) as actual, coalesce(pc.label, p::int::varchar) as predicted, n as "count",
                  round(ln(1 + n::double), 6) as heat,
                  case when n >= 1000 then (n // 1000)::varchar || 'K' when n > 0 then n::varchar else '' end as cell_text
           from (select a.label_index as a, p.final_prediction as p, coalesce(f."count", 0) as n
                 from (select distinct label_index from confusion) a
                 cross join (select distinct final_prediction from confusion) p
                 left join confusion f on f.label_index = a.label_index and f.final_prediction = p.final_prediction)
           left join classes ac on ac.label_index = a left join classes pc on pc.label_index = p""",
        "confusion",
    ),
)
def confusion_heat(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = v.Report(spark, sf_dir)
    return reports.confusion_heat(report.confusion, report.classes)


def _radar_sql(where: str, title: str) -> str:
    return f"""select '{title}' as title, round(f1, 6) as f1, round(p, 6) as "precision", round(r, 6) as recall,
                      round(greatest({v.REPORT.radar_floor}, least(f1, p, r) - {v.REPORT.radar_margin}), 6)::double as axis_floor
               from (select avg(f1) as f1, avg("precision") as p, avg(recall) as r from per_class where {where})"""


@query(
    "radar_profile",
    with_views(_radar_sql(f"label = '{v.CHOICE}'", v.CHOICE) + " union all " + _radar_sql("true", "mean"), "per_class"),
)
def radar_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_class = v.Report(spark, sf_dir).per_class
    chosen = reports.radar_profile(per_class, v.REPORT, v.CHOICE)
    return chosen.unionByName(reports.radar_profile(per_class, v.REPORT, reports.ALL))


@query(
    "drilldown",
    with_views(
        f"""select label, f1, "precision", recall, tp, fp, fn,
                   {bands("f1", QUALITY_BANDS, QUALITY_REST, ">=")} as quality from per_class""",
        "per_class",
    ),
)
def drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.drilldown(v.Report(spark, sf_dir).per_class)


@query(
    "filter_options",
    with_views("select 'ALL' as value union all select label from classes where label <> 'benign'", "classes"),
)
def filter_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.filter_options(v.classes(spark, sf_dir), v.REPORT)


@query(
    "threat_context",
    with_views(
        f"""select label as attack_type, format('{{:.2f}}%', f1) as f1_text, format('{{:.2f}}%', "precision") as precision_text,
                   format('{{:.2f}}%', recall) as recall_text, format('{{:,}}', fn) as missed_text
            from per_class where label = '{v.CHOICE}'""",
        "per_class",
    ),
)
def threat_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.threat_context(v.Report(spark, sf_dir).per_class, v.CHOICE)


@query(
    "briefing_context",
    with_views(
        """select kpi_texts.*, (select string_agg('- ' || label || ': F1=' || format('{:.2f}', f1) || '%, FN=' || fn,
                                                  chr(10) order by f1, label_index) from per_class) as class_lines
           from kpi_texts""",
        "kpi_texts",
        "per_class",
    ),
)
def briefing_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = v.Report(spark, sf_dir)
    return reports.briefing_context(_kpis(report), report.per_class)


@query(
    "critical_classes",
    with_views(f"select label, f1, fn from per_class where f1 < {_TARGET} or fn >= {_MANY_MISSED}", "per_class"),
)
def critical_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.critical_classes(v.Report(spark, sf_dir).per_class, v.REPORT, _MANY_MISSED)


@query(
    "chat_context",
    with_views(
        """select kpi_texts.*, (select string_agg(label, ', ' order by "count" desc, label) from classes
                                where label <> 'benign') as attack_types
           from kpi_texts""",
        "kpi_texts",
    ),
)
def chat_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = v.Report(spark, sf_dir)
    return reports.chat_context(_kpis(report), report.counts, v.REPORT)


_KEYS = {
    "feature_importance": ("feature",),
    "label_counts": ("label",),
    "conf_matrix": ("label_index", "final_prediction"),
    "metrics": ("metric",),
    "detection_rates": ("label",),
    "per_class_metrics": ("label",),
}


def report_tables_of(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    report = v.Report(spark, sf_dir)
    return {
        "feature_importance": v.importances(spark, sf_dir),
        "label_counts": report.counts,
        "conf_matrix": report.confusion,
        "metrics": ops.metrics_table(report.metrics),
        "detection_rates": ops.detection_rates(report.confusion, report.classes),
        "per_class_metrics": report.per_class.drop("label_index"),
    }


def _long(table: str, source: str, item: str, *measures: str) -> str:
    return " union all ".join(
        f"""select '{table}' as "table", {item} as item, '{m}' as measure, ("{m}")::double as value from {source}"""
        for m in measures
    )


_METRIC_ROWS = """(select 'Accuracy' as metric, round(accuracy * 100.0, 2) as value from metrics
    union all select 'Precision', round("precision" * 100.0, 2) from metrics
    union all select 'Recall', round(recall * 100.0, 2) from metrics
    union all select 'F1-Score', round(f1_score * 100.0, 2) from metrics)"""


@query(
    "report_tables",
    with_views(
        " union all ".join(
            (
                _long("feature_importance", "importances", "feature", "importance"),
                _long("label_counts", "classes", "label", "count"),
                _long("conf_matrix", "confusion", "label_index::int || '/' || final_prediction::int", "count"),
                _long("metrics", _METRIC_ROWS, "metric", "value"),
                _long("detection_rates", "(select label, recall as taux from per_class)", "label", "taux"),
                _long("per_class_metrics", "per_class", "label", "precision", "recall", "f1", "tp", "fp", "fn"),
            )
        ),
        "importances",
        "per_class",
        "metrics",
    ),
)
def report_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = report_dir(spark)
    names = write_reports(report_tables_of(spark, sf_dir), base)
    return reports.as_long({n: read_report(spark, base, n) for n in names}, _KEYS)


@query(
    "step_shares",
    """with log as (
           select o_orderpriority as step, count(*) as "rows", sum(floor(o_totalprice)::bigint) / 1000.0::double as seconds
           from orders where o_orderstatus <> 'P' group by all),
         steps as (
           select * from log union all
           select 'export', null, (select sum(floor(o_totalprice)::bigint) / 1000.0::double from orders) - sum(seconds) from log)
       select step, "rows", round(seconds, 3) as seconds, round(seconds / sum(seconds) over () * 100.0, 4) as percent,
              round("rows" / seconds, 4) as rows_per_second, round(seconds * 1000.0 / "rows", 6) as ms_per_row
       from steps""",
)
def step_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order priorities stand for steps and prices for seconds; pending orders are the export."""
    orders = read_table(spark, sf_dir, "orders")
    seconds = F.sum(F.floor("o_totalprice")) / 1000.0
    log = (
        orders.filter(F.col("o_orderstatus") != "P")
        .groupBy(F.col("o_orderpriority").alias("step"))
        .agg(F.count(F.lit(1)).alias("rows"), seconds.alias("seconds"))
    )
    return runlog.step_shares(log, orders.agg(seconds.alias("total")))


@query(
    "strip_markup",
    with_views(f"select doc_id, {sql_markup('text')} as text from briefings", "briefings"),
)
def strip_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_text.stripped_texts(v.briefings(spark, sf_dir), "doc_id")


_KIND = f"""case when line = '' then 'blank'
    when regexp_matches(line, '{markup.RULE}') then 'rule'
    when starts_with(line, '### ') then 'heading3'
    when starts_with(line, '## ') then 'heading2'
    when starts_with(line, '# ') then 'heading1'
    when regexp_matches(line, '{markup.SEPARATOR}') then 'separator'
    when starts_with(line, '|') then 'table_row'
    when starts_with(line, '**') and ends_with(line, '**') and length(line) > 4 then 'bold'
    when starts_with(line, '- ') or starts_with(line, '* ') then 'bullet'
    when regexp_matches(line, '{markup.NUMBERED}') then 'numbered'
    else 'text' end"""
_LINES = f"""typed as (
    select doc_id, line_no, line, {_KIND} as kind
    from (select doc_id, pos - 1 as line_no, {sql_strip("lines[pos]")} as line
          from (select doc_id, lines, unnest(generate_series(1, len(lines))) as pos
                from (select doc_id, string_split(text, chr(10)) as lines from briefings))))"""


def _with_lines(body: str) -> str:
    return f"{with_views('', 'briefings').rstrip()},\n{_LINES}\n{body}"


@query(
    "report_lines",
    _with_lines(
        f"""select doc_id, line_no, kind, {sql_markup("raw")} as body
            from (select *, case kind when 'heading3' then substr(line, 5) when 'heading2' then substr(line, 4)
                                 when 'heading1' then substr(line, 3) when 'bullet' then substr(line, 3)
                                 when 'bold' then substr(line, 3, length(line) - 4)
                                 when 'blank' then '' when 'rule' then '' else line end as raw
                  from typed where kind <> 'separator')"""
    ),
)
def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_text.report_lines(v.briefings(spark, sf_dir), "doc_id")


@query(
    "report_table_cells",
    _with_lines(
        f"""select doc_id, line_no, pos - 1 as cell_no,
                   {sql_markup("cells[pos]")} as cell, substr({sql_markup("cells[pos]")}, 1, {v.REPORT.cell_width}) as shown, is_header
            from (select doc_id, line_no, cells, unnest(generate_series(1, len(cells))) as pos,
                         line_no = min(line_no) over (partition by doc_id, table_no) as is_header
                  from (select doc_id, line_no, kind, table_no,
                               list_filter(list_transform(string_split(line, '|'), lambda c: {sql_strip("c")}),
                                           lambda c: c <> '') as cells
                        from (select *, line_no - row_number() over (partition by doc_id order by line_no) as table_no
                              from typed where kind in ('table_row', 'separator')))
                  where kind = 'table_row' and len(cells) > 0)"""
    ),
)
def report_table_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_text.table_cells(v.briefings(spark, sf_dir), "doc_id", v.REPORT.cell_width)
