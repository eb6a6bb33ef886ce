"""DuckDB SQL for those queries that SQL can express."""

from __future__ import annotations

from meteorill.llm.catalog import BAIT_HOST, URL_RULES


def _url_rules(value) -> str:
    rules = sorted(URL_RULES, key=lambda r: (-len(r.text), r.text))
    fits = "(host = '{0}' or host like '%.{0}') and starts_with(path, '{1}')"
    return "case " + " ".join(f"when {fits.format(r.host, r.path)} then '{value(r)}'" for r in rules) + " end"


URL_FILTERS = f"""
with parsed as (
  select page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages)
select page_id, host, path,
  {_url_rules(lambda r: r.text)} as rule,
  regexp_matches(host, '{BAIT_HOST}') as listed,
  coalesce({_url_rules(lambda r: r.verdict)},
    case when regexp_matches(host, '{BAIT_HOST}') then 'block' else 'allow' end) as verdict
from parsed
"""

DECONTAMINATION = """
with doc_words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words
  from documents),
item_words as (
  select item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words
  from benchmark),
item_windows as (
  select item_id, least(10, len(words)) as size, array_to_string(words[s:s + 9], ' ') as phrase
  from (select *, unnest(range(1, greatest(1, len(words) - 9) + 1)) as s from item_words where len(words) > 0)),
doc_windows as (
  select doc_id, s, size, array_to_string(words[s:s + size - 1], ' ') as phrase
  from (select *, unnest(range(1, len(words) - size + 2)) as s
        from doc_words cross join (select distinct size from item_windows) where len(words) >= size)),
found as (select distinct doc_id, s, d.size, item_id from doc_windows d join item_windows i using (phrase)
          where d.size = i.size),
hits as (select doc_id, count(distinct p) as n_hit
         from (select doc_id, unnest(range(s, s + size)) as p from found) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids
          from (select distinct doc_id, item_id from found) group by doc_id),
window_words as (
  select item_id, w, p, words[w + p] as word, least(10, len(words)) as size
  from (select item_id, words, unnest(range(1, greatest(1, len(words) - 9) + 1)) as w from item_words where len(words) > 0),
    range(10) as ps(p)
  where p < least(10, len(words))),
doc_places as (select doc_id, words[q] as word, q from (select *, unnest(range(1, len(words) + 1)) as q from doc_words)),
possible as (
  select doc_id, item_id, w from window_words join (select distinct doc_id, word from doc_places) using (word)
  group by doc_id, item_id, w, size having count(distinct p) = size),
shifts as (
  select doc_id, item_id, w, p, size, unnest(range(q - p - 3, q - p + 4)) as shift
  from possible join window_words using (item_id, w) join doc_places using (doc_id, word)),
near as (
  select distinct doc_id, item_id
  from (select doc_id, item_id, w from shifts group by doc_id, item_id, w, shift, size having count(distinct p) = size)),
near_items as (
  select doc_id, count(*) as n_near, string_agg(item_id::varchar, ',' order by item_id::varchar) as near_ids
  from near group by doc_id)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated,
  coalesce(n_near, 0)::bigint as n_near_items, sha256(coalesce(near_ids, '')) as near_sha256
from doc_words left join hits using (doc_id) left join items using (doc_id) left join near_items using (doc_id)
"""

JACCARD = """
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') as words
  from documents),
shingles as (
  select distinct doc_id, array_to_string(words[s:s + 4], ' ') as shingle
  from (select *, unnest(range(1, greatest(1, len(words) - 4) + 1)) as s from words where len(words) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as x, b.doc_id as y, count(*) as common
  from shingles a join shingles b using (shingle) where a.doc_id < b.doc_id group by all),
links as (
  select x, y from shared join sizes s on s.doc_id = x join sizes t on t.doc_id = y
  where 100 * common >= 80 * (s.n + t.n - common)),
ways as (select x, y from links union all select y, x from links),
reached as (
  select doc_id as x, doc_id as y from documents
  union
  select r.x, b.y from reached r join ways b on r.y = b.x)
select r.x as doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(y) as component_id
from reached r left join sizes on sizes.doc_id = r.x group by r.x
"""

HARD_NEGATIVES = """
with usable as (
  select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
  from usable a join usable b on a.vec_id % 100 = 0 and b.vec_id is distinct from a.vec_id),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
  row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::int as rank
from positives join scores using (anchor_id)
where not same and 80 * positive_score <= 100 * score and score <= positive_score
qualify rank <= 5
"""

SPELLING = """
with recursive runs as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n
  from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) as run from documents)
  where len(run) >= 7 group by all),
hexes as (select *, hex(encode(doc_id || ':' || run)) as bytes from runs),
sums as (
  select *, xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(len(bytes) // 2), lambda i: ('0x' || substr(bytes, 2 * i + 1, 2))::bigint)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) as h
  from hexes),
words as (
  select word, sum(n)::bigint as n
  from (select case when h % 31 = 0 then substr(run, 1, (h % len(run))::bigint) || substr(run, (h % len(run))::bigint + 2) else run end as word, n
        from sums)
  where len(word) >= 7 group by word having sum(n) >= 2),
without as (
  select word, i, substr(word, 1, i) || substr(word, i + 2) as rest from (select word, unnest(range(len(word))) as i from words)),
near as (
  select a.word, b.word as near from without a join without b using (rest, i) where a.word <> b.word
  union select without.word, words.word from without join words on words.word = rest
  union select words.word, without.word from without join words on words.word = rest),
best as (
  select near.word, count(*) as n_near, first(near order by words.n desc, near) as form, max(words.n) as form_n
  from near join words on words.word = near group by near.word),
judged as (
  select word, case when form_n >= 10 * n then form end as form, n, coalesce(n_near, 0) as n_near,
    case when form_n >= 10 * n then form_n end as form_n
  from words left join best using (word)),
followed as (
  select word, word as here, 0 as steps from words
  union all select followed.word, form, steps + 1 from followed join judged on judged.word = here where form is not null)
select judged.*, root
from judged join (select word, arg_max(here, steps) as root from followed group by word) using (word)
"""


def oracle_sql() -> dict[str, str]:
    return {"op13_spelling_variants": SPELLING, "op12_hard_negative_mining": HARD_NEGATIVES, "op8_ngram_jaccard_join": JACCARD, "op2_benchmark_decontamination": DECONTAMINATION, "op4_url_filters": URL_FILTERS}
