"""DuckDB SQL with the rows of those queries that SQL can express."""

from sparkloom.llm import fingerprints
from sparkloom.llm.decontaminate import HITS, SHARE, SPAN
from sparkloom.llm.quality import RULES, STOP_WORDS
from sparkloom.llm.url_filter import RULES as URL_RULES

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

NEAR_DEDUP = rf"""
with recursive w as (select doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as g from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from w where len(w) > 0)),
n as (select w.doc_id, count(g) as n from w left join s using (doc_id) group by 1),
links as (
  select x.a, x.b from (select p.doc_id as a, q.doc_id as b, count(*) as common from s p join s q using (g) where p.doc_id <> q.doc_id group by 1, 2) x
  join n na on na.doc_id = x.a join n nb on nb.doc_id = x.b where 100 * common >= 75 * (na.n + nb.n - common)),
reach as (select doc_id as a, doc_id as b from n union select r.a, l.b from reach r join links l on l.a = r.b),
low as (select a, min(b) as c from reach group by 1)
select doc_id, n as n_shingles, c as component_id, c = doc_id as kept from n join low on low.a = n.doc_id
"""


def _broken() -> str:
    """The rule table as one condition that holds when any rule is broken."""
    parts = []
    for r in RULES:
        value = f"cast({r.numerator} as double)"
        if r.denominator:
            value = f"(case when {r.denominator} > 0 then {value} / {r.denominator} else 0.0 end)"
        parts += [f"{value} < {r.low}"] * (r.low is not None) + [f"{value} > {r.high}"] * (r.high is not None)
    return " or ".join(parts)


_STOPS = ", ".join(f"'{w}'" for w in sorted({w for line in STOP_WORDS.values() for w in line.split()}))

QUALITY = rf"""
with d as (select doc_id, coalesce(text, '') as t, {_WORDS.format("coalesce(text, '')")} as w from documents),
g as (select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as times from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d)),
r as (select doc_id, count(distinct i + k) as n from (select doc_id, i, unnest([0, 1, 2]) as k from g where times > 1) group by 1),
l as (select doc_id, x, count(*) as times from (select doc_id, unnest(string_split(t, chr(10))) as x from d) where regexp_matches(x, '[^\x20\x09-\x0D]') group by 1, 2),
lines as (select doc_id, sum(times) as n_lines, sum(times - 1) as n_dup_lines,
  sum(case when regexp_matches(x, '^[\x20\x09]*[-*•]') then times else 0 end) as n_bullet_lines,
  sum(case when regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$') then times else 0 end) as n_ellipsis_lines from l group by 1),
s as (select doc_id, count(*) as n from (select doc_id, unnest(w) as x from d) where lower(x) in ({_STOPS}) group by 1),
m as (select d.doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols,
  len(regexp_extract_all(t, '!')) as n_exclamations, coalesce(s.n, 0) as n_stop_words, coalesce(r.n, 0) as n_repeat_words, coalesce(n_lines, 0) as n_lines,
  coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_bullet_lines, 0) as n_bullet_lines, coalesce(n_ellipsis_lines, 0) as n_ellipsis_lines
  from d left join r using (doc_id) left join lines using (doc_id) left join s using (doc_id))
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
  cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, not (n_words < 50 or 100 * n_repeat_words > 50 * n_words or {_broken()}) as kept from m
"""

SUBSTRINGS = rf"""
with d as (select doc_id, {_WORDS.format("coalesce(text, '')")} as w from documents),
g as (select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as h from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from d)),
f as (select h, min(doc_id) as low from g group by 1),
gone as (select distinct doc_id, i + k as p from (select g.doc_id, i, unnest(range(0, 50)) as k from g join f using (h) where f.low < g.doc_id)),
kept as (select x.doc_id, string_agg(x.word, ' ' order by x.p) as t, count(*) as n from
  (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d) x anti join gone on gone.doc_id = x.doc_id and gone.p = x.p group by 1)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(kept.n, 0) as bigint) as n_removed, sha256(coalesce(kept.t, '')) as kept_sha256
from d left join kept using (doc_id)
"""


_TOKENS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"

# Without seeds: every offset at which any token is equal is counted.
DECONTAMINATE = f"""
with d as (select doc_id, {_TOKENS} as w from documents), b as (select item_id, {_TOKENS} as w from benchmark),
dt as (select doc_id, unnest(w) as token, unnest(range(len(w))) as pos from d), bt as (select item_id, len(w) as n, unnest(w) as token, unnest(range(len(w))) as item_at from b),
laid as (select doc_id, item_id, n, pos - item_at as start, count(*) as matched from dt join bt using (token) group by all having count(*) >= least({SHARE} * n, case when n > {SPAN} then {HITS} else n end)),
places as (select laid.*, item_at from laid join bt using (item_id) join dt on dt.doc_id = laid.doc_id and dt.token = bt.token and dt.pos = laid.start + bt.item_at where matched < {SHARE} * laid.n),
parts as (select distinct doc_id, item_id, start from (select *, count(*) over (partition by doc_id, item_id, start order by item_at range between current row and {SPAN - 1} following) as near from places) where near >= {HITS}),
held as (select * from laid where matched >= {SHARE} * n union all select laid.* from laid join parts using (doc_id, item_id, start))
select doc_id, item_id, cast(start as integer) as start, cast(matched as integer) as matched, cast(n as integer) as n_tokens from held
qualify row_number() over (partition by doc_id, item_id order by matched desc, start) = 1
"""

_HOST = r"translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1)"
_QUERY = r"regexp_replace(regexp_replace(regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^?#]*\?([^#]*)', 1), '(^|&)(utm_[^=&]*|ref|gclid|fbclid)(=[^&]*)?', '', 'g'), '^&', '')"


def _url_filter() -> str:
    ordered = sorted(URL_RULES, key=lambda r: (-len(r.text), r.text))
    fits = [f"(host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}')" for r in ordered]
    rule = " ".join(f"when {f} then '{r.text}'" for f, r in zip(fits, ordered))
    verdict = " ".join(f"when {f} then '{r.verdict}'" for f, r in zip(fits, ordered))
    return rf"""
with p as (select page_id, {_HOST} as host, {_PATH} as path, {_QUERY} as query from pages),
c as (select *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') || case when query = '' then '' else '?' || query end as canonical,
  try_cast(regexp_extract(path, '/([0-9]+)(\.html)?/*$', 1) as bigint) as document from p),
listed as (select distinct canonical from c where host <> '' and document in (select doc_id from labels where toxic = 1))
select page_id, host, path, case {rule} end as rule,
  case {verdict} when host <> '' and canonical in (select canonical from listed) then 'block' else 'allow' end as verdict from c
"""


URL_FILTER = _url_filter()


# CRC-32 of a text: its table of 256 entries by rule, then one step per byte.
_CRC_TABLE = """tab as (select list(entry order by i) as tab from (select i, list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) as entry from range(256) r(i)))"""


def _crc(text: str) -> str:
    octets = f"list_transform(range(octet_length(encode({text}))), lambda k: cast('0x' || substr(hex(encode({text})), cast(2 * k + 1 as bigint), 2) as bigint))"
    return f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)]), 4294967295), 4294967295)"


RUNS = rf"""
with {_CRC_TABLE},
d as (select doc_id, {_WORDS.format("coalesce(text, '')")} as w, {_crc("cast(doc_id as varchar)")} as h from documents, tab),
e as (select doc_id, w, h, case when len(w) > 0 then (h // 10) % len(w) end as a from d),
f as (select doc_id, w, h, a, 1 + (len(w) - a) // (3 + (h // 10) % 8) as p from e),
t as (select doc_id, case when h % 10 = 0 and len(w) > 0 then list_transform(range(len(w)), lambda i: case when i < a then w[i + 1] else w[a + (i - a) % p + 1] end) else w end as w from f),
g as (select doc_id, len(w) as n, i, md5(array_to_string(w[i + 1:i + 5], ' ')) as gram from (select doc_id, w, unnest(range(0, len(w) - 4)) as i from t)),
same as (select x.doc_id, x.i, y.i - x.i as q from g x join g y using (doc_id, gram) where y.i > x.i and 4 * (y.i - x.i) <= x.n),
r as (select doc_id, start, length, min(q) as period from (
  select doc_id, q, min(i) as start, count(*) + 4 + q as length from (select *, i - row_number() over (partition by doc_id, q order by i) as island from same) group by doc_id, q, island)
  where length >= greatest(6, 4 * q) group by 1, 2, 3),
best as (select * from r qualify row_number() over (partition by doc_id order by length / period desc, start, period) = 1),
listed as (select doc_id, count(*) as n, string_agg(concat(start, ',', length, ',', period, chr(10)), '' order by start, period) as s from r group by 1),
gone as (select distinct doc_id, unnest(range(start + period, start + length)) as i from r),
kept as (select x.doc_id, string_agg(word, ' ' order by x.i) as s from (select doc_id, unnest(w) as word, unnest(range(len(w))) as i from t) x anti join gone on gone.doc_id = x.doc_id and gone.i = x.i group by 1)
select t.doc_id, coalesce(listed.n, 0) as n_runs, start, length, period, 1000 * length // period as exponent_milli,
  sha256(coalesce(listed.s, '')) as runs_sha256, sha256(coalesce(kept.s, '')) as collapsed_sha256
from t left join best using (doc_id) left join listed using (doc_id) left join kept using (doc_id)
"""

VARIANTS = rf"""
with recursive {_CRC_TABLE},
x as (select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as x, count(*) as n
  from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) as run from documents) group by 1, 2),
h as (select x, n, {_crc("concat(doc_id, ':', x)")} as h from x, tab),
w as (select case when h % 31 = 0 then concat(substr(x, 1, h % length(x)), substr(x, h % length(x) + 2)) else x end as word, cast(sum(n) as bigint) as n from h group by 1 having length(word) >= 7 and sum(n) >= 2),
lost as (select distinct word, n, k, concat(substr(word, 1, k - 1), substr(word, k + 1)) as rest from (select word, n, unnest(range(1, length(word) + 1)) as k from w)),
pairs as (select a.word, a.n, b.word as near, b.n as near_n from lost a join lost b on a.rest = b.rest and a.k = b.k and a.word <> b.word
  union select w.word, w.n, l.word, l.n from w join lost l on l.rest = w.word union select l.word, l.n, w.word, w.n from w join lost l on l.rest = w.word),
best as (select word, count(*) as n_near from pairs group by 1),
form as (select word, near as form, near_n as form_n from (select * from pairs qualify row_number() over (partition by word order by near_n desc, near) = 1) where near_n >= 10 * n),
chain as (select word, form as far, 1 as step from form union all select c.word, f.form, step + 1 from chain c join form f on f.word = c.far),
ends as (select word, far as root from chain qualify row_number() over (partition by word order by step desc) = 1)
select word, form, coalesce(root, word) as root, n, coalesce(n_near, 0) as n_near, form_n from w left join best using (word) left join form using (word) left join ends using (word)
"""

_K, _DIGITS, _WIDTH = fingerprints.SIZE, fingerprints.DIGITS, fingerprints.WIDTH


def _sketch(words: str) -> str:
    return f"""list_sort(list_distinct(list_transform(case when len({words}) = 0 then [] else range(greatest(len({words}) - {_WIDTH - 1}, 1)) end,
  lambda i: left(md5(array_to_string({words}[i + 1:i + {_WIDTH}], ' ')), {_DIGITS}))))[1:{_K}]"""


def _resemblance(a: str, b: str) -> str:
    union = f"list_sort(list_distinct(list_concat({a}, {b})))[1:{_K}]"
    return f"case when len({a}) = 0 and len({b}) = 0 then 1.0 else len(list_intersect({union}, list_intersect({a}, {b}))) / len({union}) end"


FINGERPRINTS = rf"""
with d as (select doc_id, coalesce(text, '') as t, coalesce(lead(text) over (order by doc_id desc), first_value(text) over (order by doc_id desc), '') as next from documents),
e as (select doc_id, t, next, substr(t, 1, length(t) - length(t) // 2) || substr(next, 1, length(t) // 2) as edited from d),
w as (select *, {_WORDS.format("t")} as wt, {_WORDS.format("edited")} as we, {_WORDS.format("next")} as wn from e),
s as (select doc_id, length(t) as n_chars, sha256(edited) as edited_sha256, {_sketch("wt")} as a, {_sketch("we")} as b, {_sketch("wn")} as c from w)
select doc_id, cast(n_chars as bigint) as n_chars, edited_sha256, array_to_string(a, '') as fingerprint, array_to_string(b, '') as edited_fingerprint,
  cast({_resemblance("a", "b")} as double) as near_edited, cast({_resemblance("a", "c")} as double) as near_next from s
"""
