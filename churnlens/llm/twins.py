"""DuckDB twins of the source audit, the vector codes and the URL filter."""

from __future__ import annotations

from churnlens.llm import source_audit as audit
from churnlens.llm import url_filter as urls
from churnlens.llm import vector_codes as vectors

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _p(count: str, total: str, terms: str) -> str:
    return f"(1 + ({audit.SCALE}::hugeint * ({count} + 2)) // ({total} + 2 * {terms}))::bigint"


SOURCE_AUDIT = f"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as text
  from documents),
t as (select r, lang, source, unnest(regexp_extract_all(text, '[^{audit.OTHER[1:]}')) as term from d),
kept as (
  select lang, term, count(*) as lang_n from t group by all having count(distinct r) >= {audit.MIN_DOCS}),
c as (select t.lang, t.source, t.term, count(*) as n from t join kept using (lang, term) group by all),
lg as (select lang, sum(lang_n)::bigint as lang_total, count(*) as terms from kept group by lang),
g as (
  select o.lang, o.source, coalesce(s.total, 0)::bigint as total, coalesce(lg.lang_total, 0) as lang_total,
         coalesce(lg.terms, 0) as terms
  from (select distinct lang, source from d) o
  left join (select lang, source, sum(n) as total from c group by all) s using (lang, source)
  left join lg using (lang)),
dense as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n, {_p("coalesce(c.n, 0)", "g.total", "g.terms")} as p,
         {_p("k.lang_n", "g.lang_total", "g.terms")} as q
  from g join kept k using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
apart as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value
  from dense a join dense b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
v as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(apart.value, 0)::bigint as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join apart on apart.lang = a.lang and apart.source = a.source and apart.item = b.source
  union all
  select lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::bigint from dense where n > 0 and p > q)
select lang, source, part, item, value,
       row_number() over (partition by lang, source, part order by value desc, item)::int as rank
from v qualify part = 'pair' or rank <= {audit.TOP}"""


def _round(i: int) -> str:
    """Assignment a{i} of every part to the codebooks b{i}."""
    return f"""
a{i} as materialized (
  select r, part, min(struct_pack(d := d, e := e)) as best from (
    select x.r, x.part, b.e, sum((x.v - b.c) * (x.v - b.c))::bigint as d
    from x join b{i} b on b.part = x.part and b.k = x.k group by all) group by all)"""


def _books(i: int) -> str:
    """Codebooks b{i}: floored means of the parts assigned in a{i - 1}."""
    return f"""
b{i} as materialized (
  select b.part, b.e, b.k, coalesce(m.c, b.c) as c from b{i - 1} b left join (
    select x.part, a.best.e as e, x.k, ((sum(x.v) - ((sum(x.v) % count(*)) + count(*)) % count(*)) // count(*))::bigint as c
    from x join a{i - 1} a on a.r = x.r and a.part = x.part group by all) m
  on m.part = b.part and m.e = b.e and m.k = b.k)"""


VECTOR_CODES = f"""
with u as materialized (
  select row_number() over (order by vec_id nulls last, embedding) as r, vec_id, embedding, label from embeddings
  where embedding is not null and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0),
dim as (select ceil(max(len(embedding)) / {vectors.PARTS}::double)::bigint as size from u),
x as materialized (
  select r, i // size as part, i % size as k,
         floor({vectors.SCALE} * coalesce(embedding[i + 1], 0)::double)::bigint as v
  from (select r, embedding, size, unnest(range({vectors.PARTS} * size)) as i from u, dim)),
b0 as materialized (
  select x.part, x.r - 1 as e, x.k, x.v as c from x join u using (r)
  where r <= {vectors.ENTRIES} and u.vec_id is not null),{_round(0)},{_books(1)},{_round(1)},{_books(2)},{_round(2)},
coded as (
  select r, string_agg(printf('%02x', best.e), '' order by part) as code, sum(best.d)::bigint as error
  from a2 group by r)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
       (select sha256(string_agg(c::varchar, ',' order by part, e, k)) from b2) as codebooks_sha256
from u join coded using (r)"""


def _url_filter() -> str:
    host = "translate(regexp_extract(rest, '^[^/?#]*', 0), '{}', '{}')".format(UPPER, LOWER)
    longest = sorted(urls.RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [(f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')", h + p, v) for h, p, v in longest]
    rule = "case " + " ".join(f"when {f} then '{name}'" for f, name, _ in fits) + " end"
    verdict = "case " + " ".join(f"when {f} then '{v}'" for f, _, v in fits) + " end"
    smoothed = lambda *args: urls.smoothed(*args).replace(" div ", " // ")
    counted = ", ".join(f"sum({c})::bigint as {c}" for c in urls.COUNTED)
    lags = ", ".join(f"lag({c}) over o as {c}_0" for c in urls.COUNTED)
    levels = "".join(f"""
s{i} as materialized (
  select *, case when len(segments) > {i} then segments[{i + 1}] end as segment,
         case when len(segments) = {i + 1} then pages else 0 end as ended, pages * shape_share as expected
  from rows{i}),
c{i} as materialized (select host, prefix, segment, {counted} from s{i} where len(segments) > {i} group by all),
o{i} as (
  select c{i}.*, {lags} from c{i} join (
    select host, prefix, sum(pages) as all_pages from c{i} group by all) using (host, prefix)
  where {urls.FREQUENT}
  window o as (partition by host, prefix order by expected / pages, segment)),
f{i} as (
  select *, sum(case when pages_0 is null or not ({urls.MERGE}) then 1 else 0 end)
              over (partition by host, prefix order by expected / pages, segment) as branch from o{i}),
n{i} as materialized (
  select host, prefix, segment,
         array_to_string(list_sort(list(segment) over (partition by host, prefix, branch)), '|') as name from f{i}),
rows{i + 1} as materialized (
  select s.host, s.segments, s.pages, s.labelled, s.blocked, s.shape_share,
         case when len(s.segments) > {i} then s.prefix || '/' || coalesce(n.name, '{urls.WILD}') else s.prefix end as prefix
  from s{i} s left join n{i} n on n.host = s.host and n.prefix = s.prefix and n.segment = s.segment),""" for i in range(urls.LEVELS))
    return f"""
with parsed as (
  select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
hosted as (
  select page_id, {host} as host,
         regexp_extract(substr(coalesce(rest, ''), length(regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0)) + 1),
                        '^[^?#]*', 0) as path
  from parsed),
u as materialized (
  select row_number() over () as r, page_id, host, path, {rule} as rule, {verdict} as verdict,
         case when path = '' then [] else string_split(regexp_replace(regexp_replace(path, '^/', ''), '[0-9]+', '#', 'g'), '/') end
           as segments
  from (select page_id, coalesce(host, '') as host, path from hosted)),
paths as materialized (
  select host, segments, count(*) as pages, count(verdict) as labelled,
         count(*) filter (where verdict = 'block') as blocked from u group by all),
overall as (
  select ({urls.UNIT} * (coalesce(sum(blocked), 0) + 1)) // (coalesce(sum(labelled), 0) + 2) as share from paths),
shape as (
  select segments, ({smoothed("sum(blocked)", "sum(labelled)", "any_value(share)")})::bigint as shape_share
  from paths, overall group by segments),
rows0 as materialized (select paths.*, shape_share, '' as prefix from paths join shape using (segments)),{levels}
t as materialized (
  select *, prefix || case when len(segments) > {urls.LEVELS} then '/{urls.TAIL}' else '' end as template
  from rows{urls.LEVELS}),
own as (
  select host, template, ({smoothed("sum(blocked)", "sum(labelled)", "(sum(pages * shape_share) // sum(pages))")})::bigint
           as blocked_share
  from t group by all)
select u.page_id, u.host, u.path, u.rule, coalesce(u.verdict, case when own.blocked_share > {urls.UNIT // 2}
         then 'block' else 'allow' end) as verdict, t.template, own.blocked_share
from u join t on t.host = u.host and t.segments = u.segments
join own on own.host = t.host and own.template = t.template"""


URL_FILTER = _url_filter()
