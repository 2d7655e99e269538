"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from telestrata.llm import collocations, spelling, urls


def _rule(value) -> str:
    """A case over the rules, the longest first."""
    cases = []
    for verdict, host, prefix in sorted(urls.RULES, key=lambda r: -len(r[1] + r[2])):
        fits = f"(host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{prefix}')"
        cases.append(f"when {fits} then '{value(verdict, host, prefix)}'")
    return f"case {' '.join(cases)} end"


def _order(k: int) -> str:
    """Smoothed probabilities of all grams of ``k`` characters and their contexts."""
    low = "1.0::double / c.kinds" if k == 0 else "b.{0}_p"
    below = "" if k == 0 else f"join p{k - 1} b on b.gram = right(h.gram, {k})"
    shares = ", ".join(
        f"(h.{s} + greatest(c.{s}_kinds, 1) * ({low.format(s)})) / (c.{s}_n + greatest(c.{s}_kinds, 1)) as {s}_p"
        for s in ("allow", "block")
    )
    return f"""
h{k} as (select right(gram, {k + 1}) as gram, sum(allow) as allow, sum(block) as block from counts group by 1),
c{k} as (
  select left(gram, {k}) as context, sum(allow)::double as allow_n, sum(block)::double as block_n,
    count(*) filter (where allow > 0) as allow_kinds, count(*) filter (where block > 0) as block_kinds,
    count(*) as kinds
  from h{k} group by 1),
p{k} as (
  select h.gram, {shares}
  from h{k} h join c{k} c on c.context = left(h.gram, {k}) {below})"""


OP3 = rf"""
with parts as (
  select page_id, coalesce(url, '') as u from pages),
base as (
  select page_id,
    translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1), '{urls.UPPER}', '{urls.LOWER}') as host,
    regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
  from parts),
ruled as (
  select *, {_rule(lambda v, h, p: h + p)} as rule, {_rule(lambda v, h, p: v)} as by_rule from base),
texts as (
  select concat(host, path) as text, by_rule, count(*) as n from ruled group by 1, 2),
places as (
  select *, unnest(range(1, length(text) + 1)) as i from texts),
grams as (
  select text, by_rule, n, substr(repeat(chr(1), {urls.ORDER}) || text, i, {urls.ORDER + 1}) as gram from places),
counts as (
  select gram, sum(case when by_rule = 'allow' then n else 0 end) as allow,
    sum(case when by_rule = 'block' then n else 0 end) as block
  from grams group by 1),
{','.join(_order(k) for k in range(urls.ORDER + 1)).strip()},
scored as (
  select text, by_rule, n, cast(sum(ratio) as double) / count(*) as mean
  from grams join (
    select gram, cast(round((ln(allow_p) - ln(block_p)) * {urls.SCALE}) as bigint) as ratio from p{urls.ORDER}) r
  using (gram) group by 1, 2, 3),
stepped as (select *, cast(floor(mean / {urls.STEP}) as bigint) as step from scored),
steps as (
  select step, sum(case when by_rule = 'allow' then n else 0 end) as allow,
    sum(case when by_rule = 'block' then n else 0 end) as block
  from stepped where by_rule is not null group by 1),
judged as (
  select *, coalesce(sum(allow) over before, 0) - coalesce(sum(block) over before, 0) as wrong
  from steps window before as (order by step rows between unbounded preceding and 1 preceding)),
best as (
  select case when (select sum(allow) > 0 and sum(block) > 0 from steps)
    then (select step from judged order by wrong, step limit 1) end as least),
models as (
  select distinct text, mean / {urls.SCALE} as score,
    case when step >= coalesce(least, step) then 'allow' else 'block' end as by_model
  from stepped, best)
select page_id, host, path, rule, coalesce(by_rule, by_model, 'allow') as verdict, coalesce(score, 0) as score
from ruled left join models on models.text = concat(host, path)
"""


# The checksum of zlib, byte by byte: a table of 256 remainders, then a fold over the bytes.
CRC32 = r"""
remainders as (
  select list(v order by b) as t from (
    select b, list_reduce(range(8), lambda c, i: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b) as v
    from (select unnest(range(256)) as b)))"""


def _crc32(text: str) -> str:
    """The checksum of a text; ``t`` are the remainders."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: cast('0x' || x as bigint))"
    step = "xor(t[xor(c, b) % 256 + 1], c >> 8)"
    return f"xor(list_reduce({octets}, lambda c, b: {step}, 4294967295), 4294967295)"


OP12 = rf"""
with recursive {CRC32.strip()},
found as (
  select coalesce(cast(doc_id as varchar), '') as id, translate(unnest(regexp_extract_all(
    text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]{{{{{spelling.LEAST_LENGTH},}}}}')), '{spelling.UPPER}', '{spelling.LOWER}') as run
  from documents),
runs as (select run, {_crc32("concat(id, ':', run)")} as h from found, remainders),
words as (
  select case when h % {spelling.DELETE_EVERY} = 0
    then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, count(*) as n
  from runs group by 1),
counted as (
  select word, n from words where length(word) >= {spelling.LEAST_LENGTH} and n >= {spelling.LEAST_COUNT}),
-- Near words share what is left without one letter, or one is that of the other.
shorter as (
  select distinct word, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
  from (select word, unnest(range(1, length(word) + 1)) as i from counted)),
near as (
  select a.word, b.word as other from shorter a join shorter b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select s.word, c.word from shorter s join counted c on c.word = s.rest
  union select c.word, s.word from shorter s join counted c on c.word = s.rest),
best as (
  select near.word, count(*) as n_near, max(o.n) as most,
    min(struct_pack(n := -o.n, w := other)).w as form
  from near join counted o on o.word = near.other group by 1),
formed as (
  select c.word, c.n, coalesce(n_near, 0) as n_near,
    case when most >= {spelling.FORM_RATIO} * c.n then form end as form,
    case when most >= {spelling.FORM_RATIO} * c.n then most end as form_n
  from counted c left join best using (word)),
chain as (
  select word, coalesce(form, word) as at from formed
  union all
  select chain.word, f.form from chain join formed f on f.word = chain.at where f.form is not null and chain.at <> chain.word),
ends as (select chain.word, chain.at as root from chain join formed f on f.word = chain.at where f.form is null)
select word, form, root, n, n_near, form_n from formed join ends using (word)
""".replace("{{", "{").replace("}}", "}")


def _grams(k: int) -> str:
    return f"""
  select lang, {k} as k, array_to_string(w[i : i + {k - 1}], ' ') as phrase
  from (select lang, w, unnest(range(1, len(w) - {k - 2})) as i from worded)"""


_UP, _DOWN = collocations.DROPPED_AT
OP13 = rf"""
with pieces as (
  select coalesce(lang, '{collocations.NO_LANGUAGE}') as lang,
    unnest(regexp_split_to_array(translate(text, '{spelling.UPPER}', '{spelling.LOWER}'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents where text is not null),
worded as (
  select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
totals as (select lang, cast(sum(len(w)) as bigint) as n from worded group by 1),
grams as ({' union all '.join(_grams(k) for k in range(1, collocations.LONGEST + 1))}),
counts as (select lang, k, phrase, count(*) as n from grams group by all having count(*) >= {collocations.SUPPORT}),
cuts as (
  select lang, k, phrase, n as a, c, array_to_string(string_split(phrase, ' ')[1 : c], ' ') as l_part,
    array_to_string(string_split(phrase, ' ')[c + 1 :], ' ') as r_part
  from (select *, unnest(range(1, k)) as c from counts where k >= 2)),
scored as (
  select cuts.lang, cuts.k, cuts.phrase, a, x.n as l, y.n as r,
    cast((1000000::hugeint * a * a) // (x.n::hugeint * y.n) as bigint) as score, c
  from cuts join counts x on x.lang = cuts.lang and x.phrase = l_part
    join counts y on y.lang = cuts.lang and y.phrase = r_part),
least as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, c) = 1),
longer as (
  select lang, array_to_string(string_split(phrase, ' ')[i : i + 1], ' ') as phrase, max(n) as outer_n
  from (select *, unnest([1, 2]) as i from counts where k = 3) group by all),
kept as (
  select least.* from least left join longer on longer.lang = least.lang and longer.phrase = least.phrase and k = 2
  where coalesce({_DOWN} * outer_n < {_UP} * a, true)),
placed as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n, score from placed join totals using (lang) where rank <= {collocations.TOP}
"""

ORACLES: dict[str, str] = {"op3_urls": OP3, "op12_spelling": OP12, "op13_collocations": OP13}
