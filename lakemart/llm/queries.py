"""The registered queries over the text tables, and their SQL for another engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, dedup, jaccard, langid, packing, pieces, prefixes, quality, secret_scan, sharding, spelling, toxicity, urls

#: The rules of the URL query: (host, path, verdict).
URL_RULES = [
    urls.Rule("com", "/", "allow"),
    urls.Rule("example.com", "/en/", "block"),
    urls.Rule("www.example.com", "/en/", "allow"),
    urls.Rule("net", "/es/", "block"),
    urls.Rule("net", "/fr/", "block"),
]


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out(key: str = "doc_id") -> Column:
    """Rows that no model learns from; so is a row without an id."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def op1_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return quality.judged(documents(spark, sf_dir)).select("doc_id", *counts, "base_failed", "kept")


def op2_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = sharding.even_tree(2, 2, 4)
    return sharding.shard_documents(documents(spark, sf_dir), tree, sharding.grown(tree))


def op3_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)


def op4_script_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.learn(docs.where(~held_out()))
    found = langid.identify(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op5_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity_classifier(spark, docs, sf_dir))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted)


def toxicity_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Classifier:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.train(docs.where(~held_out()), labels)


def op6_forced_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))


def op7_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))


def op8_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(documents(spark, sf_dir))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, sf_dir)).drop("row")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_groups(documents(spark, sf_dir)).drop("row")


def op11_offset_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(documents(spark, sf_dir), tokenizer("piece_bpe_32k.model"))


def op12_gram_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def op13_rollup_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_divergence, op2_hash_tree, op3_url_trie, op4_script_viterbi, op5_nnpu, op6_forced_boundaries, op7_best_fit,
        op8_ownership, op9_jaccard_join, op10_exact_dedup, op11_offset_pieces, op12_gram_blocks, op13_rollup_trie,
    )
}

OP3 = r"""
with u as (
  select page_id, case when strpos(coalesce(url, ''), '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages
), p as (
  select page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from u
), rules(h, s, verdict) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), best as (
  select page_id, host, path, h || s as rule, verdict,
    row_number() over (partition by page_id order by length(h || s) desc nulls last) as place
  from p left join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, s)
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from best where place = 1
"""



def _op1_sql() -> str:
    lists = quality.COMMON_WORDS
    quoted = {name: "[" + ", ".join(f"'{w}'" for w in some) + "]" for name, some in lists.items()}
    most = ", ".join(f"{{'n': len(list_filter(clean, lambda w: list_contains({some}, w))), 'o': {-i}, 'l': '{name}'}}" for i, (name, some) in enumerate(quoted.items()))
    own = " ".join(
        f"when '{name}' then list_transform({some}, lambda c: len(list_filter(clean, lambda w: w = c)))" for name, some in quoted.items()
    )

    def distances(before: str, after: str, rows: str) -> str:
        """Distances from the sums over the rows, and who is usual by them."""
        term = "case when {0} > 0 then {0} * log2({0} / ((p + q) / 2)) else 0 end"
        return f"""
{before} as (select spoken, kind, k, sum(x) as s from h where not base_failed and {rows} group by all),
{before}_n as (select spoken, kind, k, s / sum(s) over (partition by spoken, kind) as q from {before}),
{after} as (
  select doc_id, max(case when kind = 'c' and n_chars < {quality.MIN_CHARS} or kind = 'w' and n_words < {quality.MIN_WORDS} then 0 else d end
                     - case kind when 'c' then {quality.MAX_CLASS_DISTANCE} else {quality.MAX_WORD_DISTANCE} end) <= 0 as usual
  from (
    select doc_id, kind, n_chars, n_words, sqrt(greatest(sum({term.format("p")} + {term.format("q")}) / 2, 0)) as d
    from (select doc_id, spoken, kind, k, n_chars, n_words, x / sum(x) over (partition by doc_id, kind) as p from h)
    join {before}_n using (spoken, kind, k) group by all
  ) group by doc_id
)"""

    return rf"""
with w as (
  select doc_id, lang, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), windows as (
  select doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as win
  from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from w)
), covered as (
  select doc_id, count(distinct place) as n_repeat_words
  from (select doc_id, unnest([i, i + 1, i + 2]) as place from windows qualify count(*) over (partition by doc_id, win) > 1)
  group by doc_id
), lines as (
  select doc_id, count(*) - count(distinct line) as n_dup_lines
  from (select doc_id, unnest(string_split(text, chr(10))) as line from w) where regexp_matches(line, '[^\x20\x09-\x0D]')
  group by doc_id
), counted as (
  select doc_id, lang, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words, length(text) as n_chars,
    length(regexp_replace(text, '[^A-Z]+', '', 'g')) as upper, length(regexp_replace(text, '[^0-9]+', '', 'g')) as digits,
    length(regexp_replace(text, '[^.,;:!?''"()-]+', '', 'g')) as points, length(regexp_replace(text, '[\x00-\x7F]+', '', 'g')) as wide,
    list_transform(words, lambda x: lower(rtrim(x, '.,;:!?'))) as clean
  from w left join covered using (doc_id) left join lines using (doc_id)
), spoken as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    case when lang in ({", ".join(f"'{name}'" for name in lists)}) then lang else list_max([{most}]).l end as spoken
  from counted
), histograms as (
  select *, [upper, digits, points, n_symbols, wide, n_chars - word_chars, word_chars - upper - digits - points - n_symbols - wide] as classes,
    case spoken {own} end as common
  from spoken
), h as (
  select doc_id, spoken, base_failed, n_chars, n_words, 'c' as kind, unnest(classes) as x, unnest(range(len(classes))) as k from histograms
  union all
  select doc_id, spoken, base_failed, n_chars, n_words, 'w', unnest(all_common), unnest(range(len(all_common)))
  from (select *, list_append(common, n_words - list_sum(common)) as all_common from histograms)
),{distances("first", "first_usual", "true")},{distances("second", "second_usual", "doc_id in (select doc_id from first_usual where usual)")}
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
  n_repeat_words::bigint as n_repeat_words, base_failed, not base_failed and usual as kept
from spoken join second_usual using (doc_id)
"""


OP1 = _op1_sql()


def _op8_sql() -> str:
    plain = {"assign": secret_scan.ASSIGN, "access": secret_scan.ACCESS, "hex": "[0-9a-f]{32,}", "bare": "[A-Za-z0-9+/_=-]{20,}"}
    found = " union all ".join(
        f"""select doc_id, owner, repository, '{kind}' as kind, {i} as ord, regexp_extract_all(text, '{p}') as ms,
  regexp_extract_all(text, '{p}', {secret_scan.KINDS[kind][1]}) as vs, string_split_regex(text, '{p}') as gs from t"""
        for i, (kind, p) in enumerate((k, p.replace("'", "''")) for k, p in plain.items())
    )
    return rf"""
with t as (select doc_id, coalesce(text, '') as text, coalesce(source, '') as owner, md5(coalesce(text, '')) as repository from documents),
found as ({found}),
each as (
  select doc_id, owner, repository, kind, ord, i, length(ms[i]) as n, vs[i] as v, sum(length(gs[i]) + length(ms[i])) over (partition by doc_id, kind order by i) as e
  from (select *, unnest(range(1, len(ms) + 1)) as i from found)
), passed as (
  select doc_id, owner, repository, kind, ord, e - n as s, e, v from each
  where case kind when 'assign' then length(v) >= {secret_scan.LEAST_VALUE}
    when 'bare' then regexp_matches(v, '[0-9]') and regexp_matches(v, '[A-Za-z]') and len(list_distinct(string_split(v, ''))) >= {secret_scan.LEAST_CHARACTERS}
    else true end
), owners as (
  select v, count(distinct owner) as owners, count(*) as repositories
  from (select v, repository, min(owner) as owner from passed group by v, repository) group by v
),
spans as (
  select p.*, owners, repositories from passed p join owners using (v)
  where kind <> 'bare' or owners < {secret_scan.EXAMPLE_OWNERS} and not exists (
    select 1 from passed b where b.kind <> 'bare' and b.doc_id = p.doc_id and b.s < p.e and b.e > p.s)
), per_doc as (
  select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' order by s, ord) filter (kind <> 'bare') as base,
    string_agg(kind || ':' || s || ':' || e, ',' order by s, ord) as spans,
    count(*) filter (owners < {secret_scan.EXAMPLE_OWNERS}) as n_live, count(*) filter (owners >= {secret_scan.EXAMPLE_OWNERS}) as n_examples,
    max(repositories) as n_repositories
  from spans group by doc_id
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live, coalesce(n_examples, 0) as n_examples,
  coalesce(n_repositories, 0) as n_repositories
from documents left join per_doc using (doc_id)
"""


OP8 = _op8_sql()

OP9 = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as words
  from documents
), g as (
  select distinct doc_id, unnest(case when len(words) >= 5
    then list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
    when len(words) > 0 then [array_to_string(words, ' ')] else [] end) as gram
  from w
), n as (select doc_id, count(*) as n from g group by doc_id),
common as (select doc_id, gram from g where gram in (select gram from g group by gram having count(*) > 1)),
o as (
  select a.doc_id as a, b.doc_id as b, count(*) as shared
  from common a join common b on a.gram = b.gram and a.doc_id <> b.doc_id group by 1, 2
), links as (
  select a, b from o join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= 75 * (x.n + y.n - shared)
), reach as (
  select doc_id, doc_id as least from documents
  union
  select l.b, r.least from reach r join links l on l.a = r.doc_id
)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, r.component_id
from documents d left join n using (doc_id)
join (select doc_id, min(least) as component_id from reach group by doc_id) r using (doc_id)
"""

OP10 = r"""
with t as (
  select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256
  from documents
)
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
  doc_id = max(doc_id) over g as kept, text_sha256
from t window g as (partition by text_sha256)
"""

# The unsigned CRC-32 of an ASCII or UTF-8 text, from its table.
_CRC_TABLE = """crc_table as (
  select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
  from range(256) r(i)
)"""


def _crc(octets: str) -> str:
    """Of a list of byte values, in a query that has ``crc_table``."""
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {octets}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


_OCTETS = """list_transform(regexp_extract_all(hex(encode({0})), '..'), lambda x: ('0x' || x)::bigint)"""

OP12 = rf"""
with recursive {_CRC_TABLE}, found as (
  select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
  from documents
), counted as (select doc_id, run, count(*) as n from found group by all),
hashed as (select *, {_crc(_OCTETS.format("doc_id || ':' || run"))} as h from counted, crc_table),
worn as (
  select case when h % 97 = 0 then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2) else run end as word, n from hashed
), words as (select word, sum(n)::bigint as n from worn where length(word) >= 5 group by word having sum(n) >= 3),
cut as (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from (select *, unnest(range(1, length(word) + 1)) as i from words)),
near as (
  select a.word, b.word as other, b.n from cut a join cut b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select w.word, c.word, c.n from words w join cut c on c.rest = w.word
  union select c.word, w.word, w.n from words w join cut c on c.rest = w.word
), best as (
  select word, count(*) as n_near, max(n) as best_n, first(other order by n desc, encode(other)) as best from near group by word
), forms as (
  select word, w.n, case when best_n >= 2 * w.n then best end as form, case when best_n >= 2 * w.n then best_n end as form_n, coalesce(n_near, 0)::bigint as n_near
  from words w left join best using (word)
), walk as (
  select word, word as at from forms
  union select w.word, f.form from walk w join forms f on f.word = w.at where f.form is not null
)
select f.word, f.form, w.at as root, f.n, f.n_near, f.form_n
from forms f join walk w on w.word = f.word join forms e on e.word = w.at and e.form is null
"""

OP13 = rf"""
with {_CRC_TABLE}, own as (
  select conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} order by turn nulls first, coalesce(role, ''), text) as turns
  from conversations where conv_id is not null group by conv_id
), sized as (select *, ({_crc(_OCTETS.format("conv_id::varchar"))} % 6)::bigint as h from own, crc_table),
made as (
  select s.conv_id, case when s.h = 0 then s.turns else list_concat(coalesce(b.turns[1:s.h], []), s.turns[s.h + 1:]) end as turns
  from sized s left join own b on b.conv_id = s.conv_id - s.conv_id % 100
), prefixes as (select conv_id, unnest(range(0, len(turns) + 1)) as depth, turns from made),
keyed as (select conv_id, depth, len(turns) as length, turns[1:depth] as key from prefixes),
nodes as (
  select key, depth, min(conv_id) as conv_id, count(*) as n_convs, coalesce(length(key[-1].text), 0) as chars,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (length = depth), '')) as ends_sha256
  from keyed group by key, depth
), linked as (
  select n.*, p.conv_id as parent_conv_id, coalesce(c.n_children, 0) as n_children
  from nodes n left join nodes p on p.depth = n.depth - 1 and p.key = n.key[1:n.depth - 1] and n.depth > 0
  left join (select key[1:depth - 1] as key, depth - 1 as depth, count(*) as n_children from nodes where depth > 0 group by all) c on c.key = n.key and c.depth = n.depth
), below as (
  select key[1:up] as key, up as depth, count(*) filter (n_children = 0) as n_leaves, sum((n_convs - 1) * chars) as saved_tokens
  from (select *, unnest(range(0, depth + 1)) as up from linked) group by all
)
select conv_id, depth::bigint as depth, parent_conv_id, n_convs::bigint as n_convs, n_children::bigint as n_children, n_leaves::bigint as n_leaves,
  saved_tokens::bigint as saved_tokens, ends_sha256
from linked join below using (key, depth)
"""

ORACLES: dict[str, str] = {
    "op1_divergence": OP1, "op3_url_trie": OP3, "op8_ownership": OP8, "op9_jaccard_join": OP9, "op10_exact_dedup": OP10,
    "op12_gram_blocks": OP12, "op13_rollup_trie": OP13,
}
