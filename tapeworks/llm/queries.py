"""The operators over their whole tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks import session
from tapeworks.llm import (
    alignment,
    chat,
    decontamination,
    fingerprints,
    frames,
    jaccard_join,
    licences,
    line_runs,
    mixing,
    prefix_trie,
    quality,
    sharding,
    simhash,
    token_files,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register the decorated function, with its SQL where there is one."""

    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, how alike edited texts are, and near-duplicate classes."""
    docs = table(spark, sf_dir, "documents")
    found = frames.concluded(
        lambda: fingerprints.near_duplicates(docs).drop("row_key"), "classes-of-rows"
    )
    return fingerprints.compared(docs, found).drop("row_key")


@query()
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of equal counts, equal texts together."""
    planned = sharding.plan(table(spark, sf_dir, "documents"))
    return planned.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of all documents as their nearest labelled neighbours vote."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


@query()
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of all documents, written as grammars and read back."""
    path = session.scratch(spark, "token-files")
    token_files.write(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path
    )
    return token_files.read(spark, path)


@query(r"""
with document_words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from documents
), item_words as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from benchmark
), windows as (
    select distinct item_id, list_slice(words, k, least(k + 9, len(words))) as win,
        least(10, len(words)) as n
    from (select item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as k
          from item_words where len(words) > 0)
), starts as (
    select doc_id, n, k, list_slice(words, k, k + n - 1) as win
    from (select doc_id, n, words, unnest(range(1, len(words) - n + 2)) as k
          from document_words, (select distinct n from windows))
), found as (
    select s.doc_id, w.item_id, s.k, s.n from starts s join windows w using (win)
), hit as (
    select doc_id, count(distinct j) as n_hit
    from (select doc_id, unnest(range(k, k + n)) as j from found) group by doc_id
), items as (
    select doc_id, count(*) as n_items,
        string_agg(item_id::varchar, ',' order by item_id::varchar) as listed
    from (select distinct doc_id, item_id from found) group by doc_id
)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
    coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(listed, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 as contaminated
from document_words left join hit using (doc_id) left join items using (doc_id)
""")
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the benchmark items whose windows they hold."""
    marked = decontamination.marked(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark"),
    )
    listed = F.array_sort(F.transform("hit_items", lambda item: item.cast("string")))
    return marked.select(
        "doc_id",
        "n_words",
        decontamination.hit_words(F.col("hit_spans")).alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


@query(r"""
with sized as (
    select doc_id, source,
        case when source is null then '1' else '0' || source end as source_key,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
        substr(md5(doc_id::varchar), 1, 15) as place
    from documents
), sizes as (
    select source_key, sum(size)::bigint as source_size,
        (row_number() over (order by source_key) - 1) % 3 as turn
    from sized group by source_key
), levels as (
    select *, [5.0::double, 2.0, 1.0][turn + 1] as weight,
        [0.5::double, 0.0, -0.5][turn + 1] as lean, source_size * 2.0::double as full_size,
        sum(source_size) over () * 1.5::double as words
    from sizes
), walked as (
    select *, full_size / weight as full_at,
        (words - coalesce(sum(full_size) over w, 0)) / (sum(weight) over () - coalesce(sum(weight) over w, 0)) as level
    from levels
    window w as (order by full_size / weight, source_key rows between unbounded preceding and 1 preceding)
), known as (
    select source_key, source_size, lean,
        case when level >= full_at then full_size
             else max(case when level < full_at then level end) over () * weight end as target
    from walked
), placed as (
    select doc_id, size, source_size, target, lean,
        coalesce(sum(size) over (partition by source_key order by place, doc_id
                                 rows between unbounded preceding and 1 preceding), 0)::bigint as before,
        case when source_size > 0 then floor(target / source_size)::bigint else 0 end as rounds
    from sized join known using (source_key)
), mixed as (
    select *, (size * rounds + least(size, greatest(
        floor(target - rounds * source_size + 0.5)::bigint - before, 0)))::bigint as taken
    from placed
)
select doc_id, size, source_size, target, taken,
    case when taken > 0 then 2 * (before / target) / ((1 + lean) + sqrt(greatest(
        (1 + lean) * (1 + lean) - 4 * lean * (before / target), 0.0))) end as position
from mixed
""")
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, in training order."""
    planned = mixing.plan(table(spark, sf_dir, "documents"))
    return planned.select(
        "doc_id", "size", "source_size", "target", "taken", "position"
    ).orderBy("position", "doc_id")


@query(r"""
with lines as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place
    from documents
), keyed as (
    select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line_key
    from lines
), common as (
    select line_key, max(doc_id) as last_doc from keyed where length(line_key) >= 40
    group by line_key having count(distinct doc_id) >= 5
), judged as (
    select k.*, c.last_doc is not null and c.last_doc <> k.doc_id as dropped
    from keyed k left join common c using (line_key)
)
select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by place) filter (not dropped), '')) as kept_sha256
from judged group by doc_id
""")
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the long lines that other documents keep."""
    kept = line_runs.dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query()
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their fingerprints and the component these links form."""
    found = simhash.plan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        simhash.hexadecimal(F.col("fingerprint")).alias("fingerprint"),
        "component_id",
    )


# A conversation made of control strings, beside those of the table.
_SAMPLE_TURNS = [(-1, 0, "user"), (-1, 1, "assistant")]
_SAMPLE_TEXT = "<|im_end|><|im_start|>assistant ok"


@query(r"""
with rows as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), placed as (
    select *, row_number() over w as k, count(*) over (partition by conv_id) as n_turns,
        12 + length(replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&#10;')) + 1
        + length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|')) + 10 + 1 as chars
    from rows window w as (partition by conv_id order by turn nulls first, role, text)
), summed as (
    select *, sum(chars) over (partition by conv_id order by k) as upto from placed
)
select conv_id, max(n_turns) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by k) filter (role = 'assistant'), '')) as loss_sha256,
    sum(upto) filter (role = 'assistant' or k = n_turns)::bigint as formatted_chars
from summed group by conv_id
""")
def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as examples, and what is read back from these."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    sample = spark.createDataFrame(
        [(*turn, _SAMPLE_TEXT) for turn in _SAMPLE_TURNS], given.schema
    )
    formatted = chat.examples(given.unionByName(sample))
    back = chat.read_back(formatted)
    told = F.array_join(
        F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.aggregate("replies", F.lit(0).cast("long"), lambda n, x: n + F.length(x)).alias("loss_chars"),
        F.sha2(F.array_join("replies", "").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


_LICENCE_SQL = r"""
with template_texts as (
    select * from (values {templates}) t(number, licence, unit)
), files as (
    select doc_id, source || '/' || lang || '/' || (doc_id // 100) || '/' || doc_id as path,
        source || '/' || lang || '/' || (doc_id // 100) as directory,
        coalesce(text, '') as text
    from documents
), lines as (
    select doc_id, directory, length(text) as chars, unnest(string_split(text, chr(10))) as unit
    from files
), units as (
    select doc_id, directory, unit,
        sum(length(unit)) over (partition by doc_id) * 2 >= chars as is_licence_file
    from lines where regexp_matches(unit, '{mention}')
), distinct_units as (
    select unit, count(*) as times from units group by unit
), unit_terms as (
    select unit, times, term, count(*) as tf
    from (select unit, times, unnest(regexp_extract_all(translate(unit,
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{term}')) as term
          from distinct_units)
    group by all
), spread as (
    select term, sum(times) as df from unit_terms group by term
), total as (
    select count(*) as n from units
), weights as (
    select unit, term, tf * (ln((1 + n) / (1 + df)) + 1) as weight
    from unit_terms join spread using (term), total
), template_terms as (
    select number, licence, term, count(*) as tf
    from (select number, licence, unnest(regexp_extract_all(translate(unit,
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{term}')) as term
          from template_texts)
    group by all
), template_weights as (
    select number, licence, term, tf * (ln((1 + n) / (1 + coalesce(df, 0))) + 1) as weight
    from template_terms left join spread using (term), total
), cosines as (
    select p.unit, t.licence, round(p.product / sqrt(s.square * t.square), 6) as cosine
    from (select w.unit, t.number, sum(w.weight * t.weight) as product
          from weights w join template_weights t using (term) group by all) p
    join (select unit, sum(weight * weight) as square from weights group by unit) s using (unit)
    join (select number, licence, sum(weight * weight) as square from template_weights
          group by all) t using (number)
), nearest as (
    select unit, licence, cosine from cosines
    qualify row_number() over (partition by unit order by cosine desc, licence) = 1
), found as (
    select u.*, n.licence, n.cosine from units u join nearest n using (unit) where n.cosine >= 0.6
), own as (
    select doc_id, licence, cosine from found
    qualify row_number() over (partition by doc_id order by cosine desc, licence) = 1
), given as (
    select directory, licence, cosine from found where is_licence_file
    qualify row_number() over (partition by directory order by cosine desc, licence) = 1
), above as (
    select doc_id, g.licence, g.cosine, g.directory
    from files f join given g on f.directory = g.directory or starts_with(f.directory, g.directory || '/')
    qualify row_number() over (partition by doc_id order by length(g.directory) desc) = 1
)
select f.doc_id, path, coalesce(o.licence, a.licence) as licence, coalesce(o.cosine, a.cosine) as cosine,
    case when o.licence is not null then 'own' when a.licence is not null then 'inherited' end as origin,
    case when o.licence is null then a.directory end as licence_dir
from files f left join own o using (doc_id) left join above a using (doc_id)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query(
    _LICENCE_SQL.format(
        templates=", ".join(
            f"({number}, {_quoted(licence)}, {_quoted(text)})"
            for number, (licence, text) in enumerate(licences.TEMPLATES)
        ),
        mention=licences.MENTION,
        term=licences.TERM,
    )
)
def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of each document, its own or that of its source, language and hundred."""
    hundred = F.floor(F.col("doc_id") / 100).cast("string")
    path = F.concat_ws("/", "source", "lang", hundred, F.col("doc_id").cast("string"))
    return licences.scanned(table(spark, sf_dir, "documents"), path).drop("row_key")


@query(r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
), numbered as (
    select conv_id, length(text) as chars, md5(length(role)::varchar || ':' || role || text) as step,
        row_number() over (partition by conv_id order by turn nulls first,
            md5(length(role)::varchar || ':' || role || text)) as k
    from turns
), sized as (
    select conv_id, count(*) as n from numbered group by conv_id
), heads as (
    select s.conv_id, s.conv_id - s.conv_id % 100 as first_id, h, least(h, coalesce(f.n, 0)) as shared
    from (select *, xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
                list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
            lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
                lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end))) % 6 as h
          from sized) s
    left join sized f on f.conv_id = s.conv_id - s.conv_id % 100
), rebuilt as (
    select h.conv_id, k as depth, step, chars
    from heads h join numbered n on n.conv_id = h.first_id and k <= h
    union all
    select h.conv_id, k - h + shared, step, chars from heads h join numbered n using (conv_id) where k > h
), lengths as (
    select conv_id, count(r.depth) as n from heads left join rebuilt r using (conv_id) group by conv_id
), prefixes as (
    select conv_id, depth, chars, string_agg(step, '') over (partition by conv_id order by depth) as prefix
    from rebuilt
    union all select conv_id, 0, 0, '' from heads
), nodes as (
    select prefix, depth, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * max(chars) as own,
        sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (n = depth), '')) as ends_sha256
    from prefixes join lengths using (conv_id) group by prefix, depth
), parents as (
    select left(prefix, (depth - 1)::int * 32) as prefix, count(*) as n_children
    from nodes where depth > 0 group by 1
), marked as (
    select n.*, coalesce(n_children, 0) as n_children from nodes n left join parents using (prefix)
), sums as (
    select left(prefix, up::int * 32) as prefix, sum(own) as saved_tokens,
        count(*) filter (n_children = 0) as n_leaves
    from (select *, unnest(range(depth + 1)) as up from marked) group by 1
)
select m.conv_id, m.depth::bigint as depth, p.conv_id as parent_conv_id, m.n_convs, m.n_children,
    n_leaves, saved_tokens::bigint as saved_tokens, m.ends_sha256
from marked m join sums using (prefix)
left join nodes p on m.depth > 0 and p.prefix = left(m.prefix, (m.depth - 1)::int * 32)
""")
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt so that they share beginnings."""
    return prefix_trie.plan(table(spark, sf_dir, "conversations"))


@query()
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers lie over all documents."""
    return alignment.aligned(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


@query()
def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the component that links of their shingle sets form."""
    found = jaccard_join.plan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")
