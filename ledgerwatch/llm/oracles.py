"""DuckDB SQL of the filter audit, the set join, near-duplicates and conversation repair, stated from their descriptions."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

FILTER_AUDIT = rf"""
    with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents),
    w as (select *, regexp_extract_all(text, '{WORD}') as ws, min(doc_id) over (partition by text) as first from d),
    l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
    m as (select w.part,
                 case when len(ws) < 100 then 1 else 0 end
                 + case when 100 * len(list_distinct(ws)) < 80 * len(ws) then 2 else 0 end
                 + case when 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) then 4 else 0 end
                 + case when regexp_matches(text, '[#$%&*|]') then 8 else 0 end
                 + case when w.doc_id > first then 16 else 0 end as mask,
                 coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
          from w left join l on w.doc_id = l.doc_id),
    c as (select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from m group by part, mask),
    f as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) as f(x, bit)),
    o as (select a.x || b.x || c.x || d.x || e.x as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
          from f a, f b, f c, f d, f e
          where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and a.bit | b.bit | c.bit | d.bit | e.bit = 31),
    s as (select filter_order, step::int as step, bits[step] as bit, coalesce(list_sum(bits[:step - 1]), 0)::int as before
          from o, range(1, 6) as r(step)),
    t as (select part, filter_order, step, bit,
                 coalesce(sum(n) filter (mask & (before + bit) = 0), 0)::bigint as kept,
                 coalesce(sum(n) filter (mask & before = 0 and mask & bit > 0), 0)::bigint as removed,
                 coalesce(sum(n) filter (mask & before > 0 and mask & bit > 0), 0)::bigint as redundant,
                 coalesce(sum(n) filter (mask = bit), 0)::bigint as unique_fails,
                 coalesce(sum(good) filter (mask & before = 0 and mask & bit > 0), 0)::bigint as good_lost,
                 coalesce(sum(toxic) filter (mask & before = 0 and mask & bit > 0), 0)::bigint as toxic_lost
          from c, s group by part, filter_order, step, bit)
    select * exclude (bit), (sum(removed) over (partition by part, bit))::bigint as shapley from t"""


def set_links(shingle: int, percent: int, kept: bool = False) -> str:
    """Components of documents whose distinct shingles are similar enough: all pairs of sets that share a shingle."""
    more = ", coalesce(r.doc_id = coalesce(component_id, r.doc_id), true) as kept" if kept else ""
    return rf"""
    with recursive
    d as (select doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{WORD}') as w from documents),
    r as (select doc_id, list_sort(list_distinct(case when len(w) = 0 then []::varchar[]
                 when len(w) < {shingle} then [array_to_string(w, ' ')]
                 else list_transform(range(1, len(w) - {shingle} + 2), lambda i: array_to_string(w[i:i + {shingle - 1}], ' ')) end)) as g from d),
    c as (select row_number() over () as node, g, len(g) as n, least
          from (select g, min(doc_id) as least from r where len(g) > 0 and doc_id is not null group by g)),
    u as (select node, n, unnest(g) as x from c),
    e as (select a.node as a, b.node as b from u a join u b on a.x = b.x and a.node <> b.node
          where 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
          group by a.node, a.n, b.node, b.n having 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
    reach as (select node, node as other from c union select reach.node, e.b from reach join e on reach.other = e.a),
    k as (select reach.node, min(o.least) as component_id from reach join c o on reach.other = o.node group by reach.node),
    f as (select c.g, k.component_id from c join k using (node))
    select r.doc_id, len(r.g)::bigint as n_shingles,
           case when r.doc_id is not null then coalesce(component_id, r.doc_id) end as component_id{more}
    from r left join f on r.g = f.g"""


_CRC = """(xor(list_reduce([4294967295::bigint] || flatten(list_transform(string_split({key}, ''),
        lambda c: [ord(c)::bigint, 0, 0, 0, 0, 0, 0, 0])),
        lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295))"""
_KEY = "concat(coalesce(conv_id::varchar, ' '), ':', coalesce(turn::varchar, ' '))"


def _edit(costs: str) -> str:
    """Costs of keeping and of replacing a row, by state: ``costs`` is the list of costs behind it."""
    return f"""case when q = 0 and c = 's' then {costs}[2] + p when q <> 2 and c = 'u' then {costs}[3] + p
                    when q = 2 and c = 'a' then {costs}[4] + p else 99999 end as keep,
               {costs}[[3, 3, 4, 3][q + 1]] + 1 + p as rerole"""


CONVERSATION_REPAIR = rf"""
    with recursive
    raw as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
                   {_CRC.format(key=_KEY)} % 20 as fate from conversations),
    dam as (select conv_id, turn, case when fate = 4 then 'user' else role end as role,
                   case when fate = 1 then '' when fate = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
                   unnest(case when fate = 0 then []::int[] when fate = 3 then [1, 2] else [1] end) as copy from raw),
    pos as (select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as i,
                   row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as seen from dam),
    cls as (select conv_id, i, turn, role, text, left(role, 1) as c,
                   case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'b' when seen > 1 then 'd'
                        when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 't' else 'k' end as fault,
                   lag(left(role, 1)) over (partition by conv_id order by i) as c0 from pos),
    n as (select conv_id, max(i) as n,
                 coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
                 count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate,
                 count(*) filter (fault = 't') as truncated,
                 count(*) filter (i > 1 and c0 || c not in ('su', 'ua', 'au')) as illegal from cls group by conv_id),
    go as (select conv_id, n + 1 as i, [0, 10, 5, 0] as g from n
           union all
           select conv_id, i, [least(h[1], 5 + h[3], 10 + h[4]), least(h[2], 5 + h[3], 10 + h[4]),
                               least(h[3], 5 + h[4], 10 + h[3]), least(h[4], 5 + h[3], 10 + h[4])] as g
           from (select conv_id, i, list(h order by q) as h
                 from (select conv_id, i, q, least(g[q + 1] + 2, case when doomed then 99999 else least(keep, rerole) end) as h
                       from (select conv_id, i, g, q, doomed, {_edit("g")}
                             from (select go.conv_id, go.i - 1 as i, go.g, c, fault in ('b', 'd') as doomed,
                                          case when fault = 't' then 5 else 0 end as p
                                   from go join cls on go.conv_id is not distinct from cls.conv_id and go.i - 1 = cls.i)
                                  cross join (values (0), (1), (2), (3)) as states(q)))
                 group by conv_id, i)),
    tr as (select conv_id, 1::bigint as i, 0 as q, '' as audit, []::varchar[] as out from n
           union all
           select conv_id, case when e = 'I' then i else i + 1 end,
                  case when e = 'D' then q when e = 'K' and c = 's' then 1 when e = 'K' and c = 'u' then 2
                       when e = 'K' then 3 else [2, 2, 3, 2][q + 1] end,
                  audit || e,
                  case e when 'D' then out when 'K' then out || [role || ':' || text]
                         when 'I' then out || [case when q = 2 then 'assistant:' else 'user:' end]
                         else out || [case when q = 2 then 'assistant:' else 'user:' end || text] end
           from (select *, case when g2[q + 1] + 2 = g1[q + 1] then 'D' when g1[[3, 3, 4, 3][q + 1]] + 5 = g1[q + 1] then 'I'
                                when not doomed and keep = g1[q + 1] then 'K' else 'R' end as e
                 from (select *, {_edit("g2")}
                       from (select tr.*, a.g as g1, b.g as g2, cls.c, cls.role, cls.text, fault in ('b', 'd') as doomed,
                                    case when fault = 't' then 5 else 0 end as p
                             from tr join go a on tr.conv_id is not distinct from a.conv_id and tr.i = a.i
                             left join go b on tr.conv_id is not distinct from b.conv_id and tr.i + 1 = b.i
                             left join cls on tr.conv_id is not distinct from cls.conv_id and tr.i = cls.i
                             join n on tr.conv_id is not distinct from n.conv_id
                             where tr.i <= n.n or tr.q not in (0, 3))))),
    done as (select tr.conv_id, tr.audit, tr.out, gaps, blank, duplicate, truncated, illegal
             from tr join n on tr.conv_id is not distinct from n.conv_id where tr.i = n.n + 1 and tr.q in (0, 3)),
    first as (select conv_id, g[1]::bigint as cost from go where i = 1)
    select a.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
           coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
           coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit,
           sha256(coalesce(array_to_string(out, chr(10)), '')) as repaired_sha256
    from (select distinct conv_id from conversations) a
    left join done on a.conv_id is not distinct from done.conv_id
    left join first on a.conv_id is not distinct from first.conv_id"""
