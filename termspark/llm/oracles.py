"""DuckDB SQL with the same results as the queries that SQL can express."""

from __future__ import annotations

from termspark.llm import licenses, search, warc

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> str:
    """The list of words of a text column."""
    return (
        f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )


DECONTAMINATION = f"""
with d as (select doc_id, {words("text")} as w from documents),
b as (select item_id, {words("text")} as w from benchmark),
bw as (select distinct item_id, len(win) as k, array_to_string(win, ' ') as s from (
  select item_id, unnest(case when len(w) >= 10 then list_transform(range(1, len(w) - 8), lambda i: w[i:i+9])
                              when len(w) > 0 then [w] else [] end) as win from b)),
ks as (select distinct k from bw),
dw as (select doc_id, k, i, array_to_string(w[i:i+k-1], ' ') as s from (
  select doc_id, k, w, unnest(range(1, len(w) - k + 2)) as i from d, ks where len(w) >= k)),
hits as (select doc_id, i, dw.k, item_id from dw join bw on dw.k = bw.k and dw.s = bw.s),
places as (select doc_id, count(distinct p) as n_hit from (
  select doc_id, unnest(range(i, i + k)) as p from hits) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids from (
  select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join places using (doc_id) left join items using (doc_id)
"""


def canonical(url: str) -> str:
    plain = f"regexp_replace(trim({url}), '#.*$', '')"
    host = rf"lower(regexp_extract({plain}, '^[A-Za-z]+://([^/?]*)', 1))"
    host = f"regexp_replace(regexp_replace({host}, '^www[.]', ''), ':(80|443)$', '')"
    path = rf"regexp_replace(regexp_extract({plain}, '^[A-Za-z]+://[^/?]*([^?]*)', 1), '/+$', '')"
    query = f"string_split(regexp_extract({plain}, '[?](.*)$', 1), '&')"
    kept = (
        f"array_to_string(list_sort(list_filter({query}, lambda p: p <> '' and "
        f"not regexp_matches(lower(p), '^({warc.TRACKING})(=|$)'))), '&')"
    )
    return f"{host} || {path} || case when {kept} <> '' then '?' || {kept} else '' end"


REVISITS = f"""
with p as (select page_id, {canonical("url")} as canonical, md5(html) as m from pages),
r as (select canonical, 2 * page_id as response_id, 10 * page_id as ts, '"' || m || '"' as etag,
  cast(page_id // 100 as varchar) as modified from p
  where page_id % 4 <> 1),
v as (select canonical, 2 * page_id + 1 as revisit_id, 10 * page_id + 5 + 100000 * (page_id % 2) as ts,
  case when page_id % 7 = 0 then null when page_id % 5 = 0 then '"stale"' else 'W/"' || m || '"' end as etag,
  case when page_id % 3 = 0 then cast(page_id // 100 as varchar) end as modified, page_id from p),
j as (select v.*, r.response_id, r.etag as old_etag, r.modified as old_modified
  from v asof left join r on v.canonical = r.canonical and v.ts > r.ts),
o as (select *, case when response_id is null then 'no-response'
  when coalesce(replace(etag, 'W/', '') <> old_etag, false) or coalesce(modified <> old_modified, false)
    or not (coalesce(replace(etag, 'W/', '') = old_etag, false) or coalesce(modified = old_modified, false))
  then 'changed' else 'resolved' end as outcome from j)
select revisit_id, canonical, case when outcome = 'resolved' then response_id end as response_id, outcome,
  case when outcome = 'resolved' then 'cache-control=no-cache; content-type=text/html; date=' || page_id
    || '; etag=' || coalesce(etag, old_etag) || '; last-modified=' || coalesce(modified, old_modified) end as headers
from o
"""


def license_pattern(template: str) -> str:
    """A template as a pattern over words with a blank before each."""
    parts = []
    for mark, low, high, word in licenses.MARKUP.findall(template):
        if word:
            parts.append(f" {word.lower()}")
        elif mark == "beginOptional":
            parts.append("(?:")
        elif mark == "endOptional":
            parts.append(")?")
        else:
            parts.append(f"(?: [^ ]+){{{low},{high}}}")
    return "".join(parts) + " "


def _licenses() -> str:
    base, more, best = [], [], ["0"]
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        same = " and ".join(f"w[i+{n}] = '{word}'" for n, word in enumerate(parts))
        base.append((label, f"list_filter(range(1, len(w) - {len(parts) - 2}), lambda i: {same})"))
    for label, template in licenses.TEMPLATES.items():
        met = f"regexp_matches(j, '{license_pattern(template)}')"
        more.append(f"case when {met} then ['{label}'] else [] end")
        best.append(f"case when {met} then {len(licenses.Automaton.of(template).mandatory)} else 0 end")
    found = ", ".join(f"case when len({places}) > 0 then ['{label}'] else [] end" for label, places in base)
    places = ", ".join(p for _, p in base)
    return f"""
with d as (select doc_id, {words("text")} as w from documents),
s as (select *, ' ' || array_to_string(w, ' ') || ' ' as j, flatten([{places}]) as places, flatten([{found}]) as base from d),
l as (select *, flatten([{", ".join(more)}]) as more, greatest({", ".join(best)}) as best from s)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(places) as bigint) as n_base,
  cast(list_min(places) - 1 as bigint) as first_word, cast(list_max(places) - 1 as bigint) as last_word,
  array_to_string(list_sort(list_distinct(base)), ',') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, more))), ',') as labels,
  case when len(base) + len(more) = 0 then 0.0::double else 0.5 + 0.5 * best / (best + 4) end as score
from l
"""


LICENSES = _licenses()

TOP_DOCUMENTS = f"""
with d as (select doc_id, {words("text")} as w from documents),
t as (select doc_id, term, count(*) as tf, any_value(n) as length from (
  select doc_id, unnest(w) as term, len(w) as n from d) group by doc_id, term),
n as (select count(distinct doc_id) as docs, sum(len(w))::double / count(distinct doc_id) as mean from d where len(w) > 0),
f as (select term, count(*) as df from t group by term),
p as (select doc_id, term, cast(round(ln(1 + (docs - df + 0.5) / (df + 0.5))
    * (tf * {search.K1 + 1} / (tf + {search.K1} * ({1 - search.B} + {search.B} * length / mean))) * {search.UNIT}) as bigint) as weight
  from t join f using (term), n),
s as (select q.doc_id as query_id, p.doc_id, cast(sum(p.weight) as bigint) as score
  from t q join p using (term) where q.doc_id % 20 = 0 group by 1, 2 having sum(p.weight) > 0)
select query_id, cast(rank as int) as rank, doc_id, score from (
  select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from s) where rank <= {search.K}
"""

ORACLES = {
    "op1_decontamination": DECONTAMINATION,
    "op4_warc_revisits": REVISITS,
    "op5_license_scan": LICENSES,
    "op7_block_max_search": TOP_DOCUMENTS,
}
