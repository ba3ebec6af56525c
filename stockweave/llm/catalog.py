"""The registered queries of the operators, and the SQL for those SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm import (
    decontaminate,
    hardneg,
    htmltext,
    licenses,
    ordinal,
    packing,
    pii,
    resample,
    rules,
    secret_spans,
    simhash,
    toxicity,
    warc,
)
from stockweave.llm.common import table
from stockweave.session import run_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back."""
    folder = f"{run_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.stored_pages(spark, folder)


ORACLES["op2_warc"] = """
with p as (
    select page_id, coalesce(html, '') as payload,
           cast(octet_length(encode(coalesce(html, ''))) as bigint) as payload_bytes,
           sha1(coalesce(html, '')) as payload_digest
    from pages
), q as (
    select *, case when payload_bytes >= 1000
                   then max(page_id) over (partition by payload_digest) end as last
    from p
)
select page_id, payload_bytes, payload_digest,
       case when last is not null and page_id is distinct from last
            then 'revisit' else 'response' end as record_type,
       case when last is not null and page_id is distinct from last then last end as refers_to
from q"""


@query
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return htmltext.extract(table(spark, sf_dir, "pages"))


@query
def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses in all documents: one row per place."""
    found = licenses.matches(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", F.explode("licenses").alias("hit")).select("doc_id", "hit.*")


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and selection of all documents, by a model fitted on the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ordinal.train(docs, table(spark, sf_dir, "labels"))
    found = ordinal.scored(docs, model)
    return found.select(
        "row.doc_id",
        F.round("grade", 6).alias("expected_grade"),
        F.round("p_top", 6).alias("p_top"),
        "kept",
    )


@query
def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    found = secret_spans.find(table(spark, sf_dir, "documents"), carry=["doc_id"])

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "row.doc_id",
        *[count(kind) for kind in ("assign", "access", "hex")],
        F.sha2(secret_spans.spans_text("base"), 256).alias("base_sha256"),
        secret_spans.spans_text("all_spans").alias("spans"),
    )


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    found = pii.find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(k: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == k))).cast("long")

    return found.select(
        F.col("id").alias("doc_id"),
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)],
        F.sha2(pii.spans_text(base), 256).alias("base_sha256"),
        pii.spans_text(F.col("spans")).alias("spans"),
    )


@query
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, test item) such that a passage of the document leaks the item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in bins: one row per bin with its documents."""
    return packing.bins_of(packing.pack(table(spark, sf_dir, "documents")))


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality rules for all documents."""
    return rules.judge(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.round("class_distance", 6).alias("class_distance"),
        F.round("word_distance", 6).alias("word_distance"),
    )


@query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of all documents towards the benchmark texts, and the draw."""
    found = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").cast("long").alias("doc_id"), "n_features", "weight", "score", "rank")


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive among all embeddings."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hardneg.quantized(table(spark, sf_dir, "embeddings"), moved)
    return hardneg.mine(rows, F.col("id") % 100 == 0)


@query
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, and the number of toxic passages."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        F.col("id").alias("doc_id"),
        (toxicity.fold(F.col("id")) == toxicity.HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


def _quality_rules_sql() -> str:
    """The rules once more, exploded: windows and words are rows here."""
    space = "[\\x20\\x09-\\x0D]+"
    steps, left = [], "t"
    for k, (_, pattern) in enumerate(rules.CLASSES):
        pattern = pattern.replace("'", "''")
        steps.append(f"s{k + 1} as (select *, regexp_replace({left}, '{pattern}', '', 'g') as left{k + 1} from s{k})")
        left = f"left{k + 1}"
    n = len(rules.CLASSES)
    names = ["t", *[f"left{k + 1}" for k in range(n)]]
    sizes = ", ".join(f"length({a}) - length({b})" for a, b in zip(names, names[1:]))
    lists = " union all ".join(
        f"select '{lang}' as lang_key, '{words}' as list" for lang, words in rules.COMMON_WORDS.items()
    )
    symbols = " - ".join(["0", *[f"(length(t) - length(replace(t, '{c}', '')))" for c in rules.SYMBOLS]])

    def distance(kind: str) -> str:
        half = "case when {0} > 0 then {0} * log2({0} / (({0} + {1}) / 2)) else 0 end"
        terms = half.format("p", "q") + " + " + half.format("q", "p")
        return f"""
select rid, sqrt(greatest(sum({terms}) / 2, 0)) as distance from (
    select h.rid, h.share / {rules.UNIT}e0 as p, coalesce(r.part / nullif(r.whole, 0), 0) as q
    from {kind}_share h join {kind}_ref r using (lang_key, k)) group by rid"""

    def reference(kind: str) -> str:
        return f"""
select lang_key, k, cast(sum(share) as double) as part,
       cast(sum(sum(share)) over (partition by lang_key) as double) as whole
from {kind}_share join base using (rid, lang_key) where not base_failed group by lang_key, k"""

    return f"""
with s0 as (
    select row_number() over () as rid, doc_id, coalesce(text, '') as t,
           case when lang in ({", ".join(f"'{x}'" for x in rules.COMMON_WORDS)}) then lang else 'other' end as lang_key,
           [x for x in string_split_regex(coalesce(text, ''), '{space}') if x <> ''] as words,
           [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] as lines
    from documents
), {", ".join(steps)},
windows as (
    select rid, i, array_to_string(words[i:i + {rules.WINDOW - 1}], ' ') as w
    from (select rid, words, unnest(range(1, len(words) - {rules.WINDOW - 2})) as i from s0)
), repeated as (
    select rid, count(distinct place) as n from (
        select rid, unnest(range(i, i + {rules.WINDOW})) as place from (
            select rid, i, count(*) over (partition by rid, w) as n from windows) where n > 1)
    group by rid
), base as (
    select *, n_words < {rules.MIN_WORDS} or 100 * n_repeat_words > {rules.MAX_REPEAT_PCT} * n_words as base_failed from (
        select s{n}.rid, doc_id, lang_key, cast(len(words) as bigint) as n_words,
               cast(length(array_to_string(words, '')) as bigint) as word_chars,
               cast(-({symbols}) as bigint) as n_symbols,
               cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
               cast(coalesce(r.n, 0) as bigint) as n_repeat_words
        from s{n} left join repeated r on r.rid = s{n}.rid)
), class_counts as (
    select rid, lang_key, unnest([{sizes}, length({names[-1]})]) as x, unnest(range({n + 1})) as k from s{n}
), class_share as (
    select rid, lang_key, k, cast(case when sum(x) over (partition by rid) > 0
           then round(x * {rules.UNIT}e0 / sum(x) over (partition by rid)) else 0 end as bigint) as share
    from class_counts
), listed as (
    select lang_key, unnest(string_split(list, ' ')) as w, unnest(range(len(string_split(list, ' ')))) as k
    from ({lists})
), word_counts as (
    select s.rid, s.lang_key, l.k, coalesce(c.n, 0) as x
    from s0 s join listed l using (lang_key)
    left join (select rid, w, count(*) as n from (select rid, unnest([lower(x) for x in words]) as w from s0)
               group by rid, w) c on c.rid = s.rid and c.w = l.w
), word_share as (
    select rid, lang_key, k, sum(x) over (partition by rid) as n_common,
           cast(case when sum(x) over (partition by rid) > 0
           then round(x * {rules.UNIT}e0 / sum(x) over (partition by rid)) else 0 end as bigint) as share
    from word_counts
), class_ref as ({reference("class")}), word_ref as ({reference("word")}),
class_distance as ({distance("class")}), word_distance as ({distance("word")}),
met as (
    select b.*, coalesce(c.distance, 0) as cd, case when w.n >= {rules.MIN_COMMON_WORDS} then coalesce(d.distance, 0) else 0 end as wd
    from base b left join class_distance c using (rid) left join word_distance d using (rid)
    left join (select rid, max(n_common) as n from word_share group by rid) w using (rid)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not (n_words >= {rules.MIN_JUDGED_WORDS}
           and (cd > {rules.MAX_CLASS_DISTANCE} or wd > {rules.MAX_WORD_DISTANCE})) as kept,
       cast(round(cd, 6) as double) as class_distance, cast(round(wd, 6) as double) as word_distance
from met"""


ORACLES["op10_quality_rules"] = _quality_rules_sql()


def _secret_scans_sql() -> str:
    """Secrets once more: pieces, matches and windows are rows here."""
    q = secret_spans

    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    def placed(name: str, pattern: str, group: int) -> str:
        p = quoted(pattern)
        return f"""
{name}_pieces as (
    select rid, unnest(regexp_extract_all(t, {p}, 0)) as m, unnest(regexp_extract_all(t, {p}, {group})) as g,
           unnest(range(len(regexp_extract_all(t, {p}, 0)))) as i,
           unnest(string_split_regex(t, {p})[1:len(regexp_extract_all(t, {p}, 0))]) as piece
    from d where regexp_matches(t, {p})
), {name} as (
    select *, sum(length(m) + length(piece)) over (partition by rid order by i) as stop,
           stop - length(m) as start from {name}_pieces
)"""

    def of_class(k: int) -> str:
        digit, upper, lower = (f"regexp_matches(m, '[{x}]')" for x in ("0-9", "A-Z", "a-z"))
        mixed = f"{digit} and {upper} and {lower}"
        return (
            f"regexp_full_match(m, '[0-9A-Fa-f]+') and {digit} and regexp_matches(m, '[A-Fa-f]')",
            f"regexp_full_match(m, '[A-Za-z0-9]+') and {mixed}",
            mixed,
        )[k]

    which = "case " + " ".join(f"when {of_class(k)} then {k}" for k in range(3)) + " end"
    least = "case k " + " ".join(f"when {k} then {bits}e0" for k, (_, _, bits) in enumerate(q.CLASSES)) + " end"
    names = "case k " + " ".join(f"when {k} then '{name}'" for k, (name, _, _) in enumerate(q.CLASSES)) + " end"
    joined = "coalesce(string_agg(kind || ':' || start || ':' || stop, ',' order by start, ord), '')"
    return f"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
{placed("assign", q.ASSIGN, 2)}, {placed("access", q.ACCESS, 0)}, {placed("hex", q.HEX, 0)},
{placed("candidate", q.CANDIDATE, 0)},
usable as (
    select rid, i, m, start, {which} as k from candidate
    where {which} is not null and not regexp_matches(m, {quoted(q.ALLOWED)})
      and not regexp_matches(right(piece, {q.CONTEXT}), {quoted(q.ALLOWED_BEFORE)})
), windows as (
    select *, unnest(range(length(m) - {q.WINDOW - 1})) as pos from usable
), letters as (
    select rid, i, k, start, pos, c, count(*) as n from (
        select rid, i, k, start, pos, unnest(string_split(m[pos + 1:pos + {q.WINDOW}], '')) as c from windows)
    group by all
), hot as (
    select rid, i, k, start, pos from letters group by all
    having log2({q.WINDOW}e0) - sum(n * log2(n)) / {q.WINDOW} >= {least} - 1e-12
), spans as (
    select rid, 'assign' as kind, 0 as ord, start, stop from assign where length(g) >= {q.ASSIGN_LEAST}
    union all select rid, 'access', 1, start, stop from access
    union all select rid, 'hex', 2, start, stop from hex
    union all select rid, {names}, 3 + k, start + min(pos), start + max(pos) + {q.WINDOW} from hot group by rid, i, k, start
), folded as (
    select rid, count_if(ord = 0) as n_assign, count_if(ord = 1) as n_access, count_if(ord = 2) as n_hex,
           coalesce(string_agg(kind || ':' || start || ':' || stop, ',' order by start, ord) filter (ord < 3), '') as base,
           {joined} as spans
    from spans group by rid
)
select doc_id, cast(coalesce(n_assign, 0) as bigint) as n_assign, cast(coalesce(n_access, 0) as bigint) as n_access,
       cast(coalesce(n_hex, 0) as bigint) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join folded using (rid)"""


ORACLES["op6_secret_scans"] = _secret_scans_sql()


def _resampling_sql() -> str:
    """The resampling once more: features are rows, CRC-32 is folded over bytes by its table."""
    r = resample
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    low, high = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def words(name: str, key: str) -> str:
        text = f"translate(coalesce(text, ''), '{high}', '{low}')"
        return f"select {key}, regexp_extract_all({text}, '{word}') as words from {name}"

    # the 256 entries of the CRC-32 table, by eight shifts of the reflected polynomial
    steps = ["t0 as (select b, b::bigint as c from range(256) s(b))"]
    steps += [
        f"t{k + 1} as (select b, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end as c from t{k})"
        for k in range(8)
    ]
    return f"""
with {", ".join(steps)},
crc_table as (select list(c order by b) as c from t8),
d as ({words("documents", "row_number() over () as rid, doc_id")}),
b as ({words("benchmark", "item_id")}),
features as (
    select 1 as own, rid, unnest(words) as w from d
    union all select 0, 0, unnest(words) from b
), named as (
    select w, xor(list_reduce(
        list_prepend(4294967295::bigint, list_transform(range(octet_length(encode(w))::bigint),
            lambda i: ('0x' || substr(hex(encode(w)), 2 * i::int + 1, 2))::bigint)),
        lambda h, x: xor(h >> 8, c[(xor(h, x) & 255) + 1])), 4294967295) % {r.BUCKETS} as bucket
    from (select distinct w from features), crc_table
), counts as (
    select bucket, sum(own)::double as s, sum(1 - own)::double as t from features join named using (w) group by bucket
), totals as (select coalesce(sum(s), 0) as all_s, coalesce(sum(t), 0) as all_t from counts),
gains as (
    select bucket, floor({r.GAIN_UNIT} * ln((t + 1) * (all_s + {r.BUCKETS}) / ((s + 1) * (all_t + {r.BUCKETS}))))::bigint as gain
    from counts, totals
), weights as (
    select rid, count(*) as n, sum(gain)::bigint as weight
    from features join named using (w) join gains using (bucket) where own = 1 group by rid
), scored as (
    select rid, doc_id, coalesce(n, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
           weight_or_0 + floor(-{r.GAIN_UNIT} * ln(-ln((h + 0.5) / 4294967296)))::bigint as score
    from (select d.rid, doc_id, n, weight, coalesce(weight, 0) as weight_or_0,
                 ('0x' || substr(sha256('{r.SEED}:' || doc_id), 1, 8))::bigint::double as h
          from d left join weights using (rid))
), placed as (
    select rid, row_number() over (order by score desc, doc_id, n_features) as place, count(*) over () as n
    from scored where n_features >= {r.LEAST_WORDS} and score is not null
)
select doc_id, n_features, weight, score::bigint as score,
       case when place <= {r.PERCENT} * n // 100 then place::bigint end as rank
from scored left join placed using (rid)"""


ORACLES["op11_importance_resampling"] = _resampling_sql()

ORACLES["op12_hard_negatives"] = """
with r as (
    select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
    select a.id as anchor, o.id as other, a.label = o.label as same,
           list_inner_product(a.v, o.v)::bigint as score
    from r a join r o on a.id <> o.id where a.id % 100 = 0
), p as (
    select anchor, other as positive, score as positive_score from s where same
    qualify row_number() over (partition by anchor order by score desc, other) <= 5
)
select anchor as anchor_id, positive as positive_id, negative as negative_id, rank::int as rank,
       positive_score, negative_score
from (
    select p.*, s.other as negative, s.score as negative_score,
           row_number() over (partition by anchor, positive order by s.score desc, s.other) as rank
    from p join s using (anchor)
    where not same and 30 * positive_score <= 100 * s.score and 100 * s.score <= 90 * positive_score
) where rank <= 10"""
