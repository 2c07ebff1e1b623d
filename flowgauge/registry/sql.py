"""SQL texts of the views, put before each query's own SQL."""

from __future__ import annotations

from flowgauge.functions import markup
from flowgauge.registry.views import MEMBERS, WRONG_BASE, WRONG_STEP


def _bits(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::bigint"


def digest(seed: object, key: str = "flow_id") -> str:
    return f"md5('{seed}:' || {key})"


def bucket(seed: object, n: int, key: str = "flow_id") -> str:
    return f"(('0x' || substr({digest(seed, key)}, 1, 8))::bigint % {n})"


def below(seed: object, part: float, key: str = "flow_id") -> str:
    """Whether the 32-bit draw of a row lies below a share of 2 ** 32."""
    return f"('0x' || substr({digest(seed, key)}, 1, 8))::bigint < {round(part * 2**32)}"


def share(part: str, whole: str) -> str:
    return f"coalesce(({part})::double / nullif({whole}, 0), 0)"


PRECISION = share("tp", "tp + fp")
RECALL = share("tp", "tp + fn")
F1 = share("2 * tp", "2 * tp + fp + fn")


def bands(value: str, bounds, rest: str, op: str) -> str:
    cases = " ".join(f"when {value} {op} {bound} then '{name}'" for name, bound in bounds)
    return f"case {cases} else '{rest}' end"


_TOTAL = "coalesce(sum(f.\"count\") filter (where {}), 0)::bigint"

VIEWS = {
    "flows": """
        select event_id as flow_id, ts, user_id, event_type, value,
               try_cast(json_extract_string(props, '$.k') as double) as k,
               case when value < 40 then 'benign' when value < 80 then 'flood' when value < 120 then 'scan'
                    when event_type = 'error' then 'botnet' when event_type = 'signup' then 'brute'
                    else 'slow' end as label
        from events""",
    "dirty": """
        select flow_id, '10.0.0.' || user_id as src_ip, '10.0.1.' || user_id as dst_ip,
               case when event_type in ('click', 'view') then 'TCP' else 'UDP' end as protocol,
               user_id * 20 as total_header_bytes, value / 2 as active_min, user_id, value,
               case flow_id % 97 when 2 then 'inf' when 3 then '-inf' when 4 then 'NaN' when 5 then 'TCP'
                    when 6 then '' when 7 then null else cast(cast(round(value * 100) as bigint) as varchar) end as value_txt,
               k,
               case flow_id % 97 when 0 then 'NULL' when 1 then null else label end as label
        from flows""",
    "classes": """
        select label, (row_number() over (order by count(*) desc, label) - 1)::double as label_index,
               count(*) as "count"
        from flows group by label""",
    "members": f"""
        select flow_id, label, label_index, model,
               case when draw < {WRONG_BASE} + {WRONG_STEP} * label_index
                    then ((label_index::bigint + 1 + draw % 2) % (select count(*) from classes))::double
                    else label_index end as pred
        from (select f.flow_id, f.label, c.label_index, m.i as model,
                     {_bits("m.i || '|' || f.flow_id")} % 100 as draw
              from flows f join classes c using (label) cross join range({MEMBERS}) m(i))""",
    "voted": """
        select flow_id, label, label_index, pred as final_prediction
        from (select *, row_number() over (partition by flow_id order by n desc, place) as choice
              from (select flow_id, label, label_index, pred, count(*) as n, min(model) as place
                    from members group by all))
        where choice = 1""",
    "confusion": """
        select label_index, final_prediction, count(*) as "count" from voted group by all""",
    "totals": f"""
        select c.label, c.label_index,
               {_TOTAL.format("f.label_index = c.label_index and f.final_prediction = c.label_index")} as tp,
               {_TOTAL.format("f.label_index <> c.label_index and f.final_prediction = c.label_index")} as fp,
               {_TOTAL.format("f.label_index = c.label_index and f.final_prediction <> c.label_index")} as fn
        from classes c left join confusion f
          on f.label_index = c.label_index or f.final_prediction = c.label_index
        group by all""",
    "per_class": f"""
        select label, label_index, round({PRECISION} * 100.0, 2) as "precision",
               round({RECALL} * 100.0, 2) as recall, round({F1} * 100.0, 2) as f1, tp, fp, fn
        from totals""",
    "metrics": f"""
        select sum(tp)::double / sum(tp + fn) as accuracy,
               sum({F1} * (tp + fn)) / sum(tp + fn) as f1_score,
               sum({PRECISION} * (tp + fn)) / sum(tp + fn) as "precision",
               sum({RECALL} * (tp + fn)) / sum(tp + fn) as recall
        from totals""",
    "kpis": """
        select (select sum("count")::bigint from classes) as total_flows,
               (select coalesce(sum("count"), 0)::bigint from classes where label <> 'benign') as total_attacks,
               (select count(*) from classes) as classes,
               (select string_agg(label, ', ' order by label) from classes where label <> 'benign') as attack_types,
               (select count(*) from classes where label <> 'benign') as attack_type_count,
               (select sum(fp)::bigint from totals) as false_positives,
               round(accuracy * 100.0, 2) as accuracy, round(f1_score * 100.0, 2) as f1
        from metrics""",
    "kpi_texts": """
        select format('{:,}', total_flows) as flows_text, format('{:,}', total_attacks) as attacks_text,
               format('{:.2f}%', accuracy) as accuracy_text, format('{:.2f}%', f1) as f1_text
        from kpis""",
    "importances": """
        select p_brand as feature, sum(round(p_retailprice * 100)::bigint)::bigint / 100.0::double as importance
        from part group by p_brand""",
    "briefings": """
        select doc_id,
               '# Report ' || doc_id || E'\\n\\n## Source **' || source || E'**\\n### `' || lang
               || E'` summary\\n| key | value | note |\\n|-----|:---:|---|\\n| length | ' || n_chars
               || E' | |\\n|  id | **' || doc_id
               || E'** | a cell that is longer than thirty characters |\\n---\\n**Findings ' || doc_id
               || E'**\\n- first *point*\\n* second `point`\\n1. step\\n2) step – ✅ done\\n   \\n' || text
               || E'\\n|' || source || '|' as text
        from documents""",
}

NEEDS = {
    "dirty": ("flows",),
    "classes": ("flows",),
    "members": ("flows", "classes"),
    "voted": ("members",),
    "confusion": ("voted",),
    "totals": ("classes", "confusion"),
    "per_class": ("totals",),
    "metrics": ("totals",),
    "kpis": ("classes", "totals", "metrics"),
    "kpi_texts": ("kpis",),
}


def with_views(body: str, *names: str) -> str:
    """body with the named views, and what they need, as common table expressions."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, ()):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return body
    return "with " + ",\n".join(f"{n} as ({VIEWS[n]})" for n in ordered) + "\n" + body


def sql_markup(text: str) -> str:
    """Mark stripping as nested regular-expression replacements, written out apart from the library's patterns."""
    for mark in (r"\*\*(.*?)\*\*", r"\*(.*?)\*", r"`(.*?)`"):
        text = f"regexp_replace({text}, '{mark}', '\\1', 'g')"
    return f"regexp_replace({text}, '[^\\x00-\\x{{FF}}]', '', 'g')"


def sql_strip(text: str) -> str:
    return f"trim({text}, '{markup.WHITESPACE}')"
