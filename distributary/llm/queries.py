"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from distributary.llm import bpe, classifier, decontaminate, divergence, fill_middle, language, licenses, near_dup, quality, substrings, token_files, toxicity, url_filter
from distributary.llm.shared import read_table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(*(read_table(spark, sf_dir, name) for name in ("documents", "labels")))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (read_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.contamination(documents, benchmark)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read_table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(*(read_table(spark, sf_dir, name) for name in ("pages", "documents")))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(read_table(spark, sf_dir, "pages"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read_table(spark, sf_dir, "documents"))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(read_table(spark, sf_dir, "documents"), TOKENIZER)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.kept_digests(read_table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_checks(read_table(spark, sf_dir, "documents"), TOKENIZER)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fill_in_middle(read_table(spark, sf_dir, "documents"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.quality(*(read_table(spark, sf_dir, name) for name in ("documents", "labels")))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_license_scan": op4_license_scan,
    "op5_language_id": op5_language_id,
    "op6_url_filter": op6_url_filter,
    "op7_quality_rules": op7_quality_rules,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_token_files": op10_token_files,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_source_divergence": op13_source_divergence,
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def license_sql() -> str:
    """Phrases by position; templates as regular expressions over the words of a text."""
    spaced = "array_to_string(words, ' ') || ' '"
    phrases = " union all ".join(
        f"select r, '{label}' as label, i - 1 as place from "
        f"(select r, words, unnest(range(1, len(words) + 1)) as i from document) "
        f"where words[i : i + {len(p.split()) - 1}] = {p.split()}"
        for p, label in licenses.PHRASES.items()
    )
    templates = " union all ".join(
        f"select r, '{licenses.label_of(label)}' as label from document where regexp_matches({spaced}, '(^| ){licenses.pattern(t)}')"
        for label, t in licenses.TEMPLATES.items()
    )
    return f"""
        with document as (
            select doc_id, row_number() over () as r, coalesce(regexp_extract_all(
                translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) as words
            from documents),
        phrase as ({phrases}),
        template as ({templates}),
        base as (select r, count(*) as n_base, min(place) as first_word, max(place) as last_word,
            array_to_string(list_sort(list(distinct label)), ',') as base_labels from phrase group by r),
        every as (select r, array_to_string(list_sort(list(distinct label)), ',') as labels
            from (select r, label from phrase union all select r, label from template) group by r),
        accepted as (select distinct r, true as yes from template)
        select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
            coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
            cast(case when yes then 1.0 when n_base > 0 then 0.5 else 0.0 end as double) as score
        from document left join base using (r) left join every using (r) left join accepted using (r)
    """


def url_sql() -> str:
    """Rules from the longest to the shortest, then membership in the list."""
    fits = [
        (kind, h + p, f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')")
        for kind, h, p in sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    ]
    name = " ".join(f"when {fit} then '{rule}'" for _, rule, fit in fits)
    verdict = " ".join(f"when {fit} then '{kind}'" for kind, _, fit in fits)
    return f"""
        with page as (
            select page_id, url,
                translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') as host,
                coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') as path
            from pages),
        listed as (select distinct host, path from page where regexp_matches(url, '[?&]ref='))
        select page_id, host, path, case {name} end as rule,
            case {verdict} when l.host is not null then 'block' else 'allow' end as verdict
        from page left join listed l using (host, path)
    """


ORACLES: dict[str, str] = {
    "op4_license_scan": license_sql(),
    "op6_url_filter": url_sql(),
    "op3_decontamination": """
        with item as (
            select cast(item_id as varchar) as item,
                regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
            from benchmark where item_id is not null),
        item_window as (
            select distinct item, array_to_string(words[i : i + least(10, len(words)) - 1], ' ') as span,
                least(10, len(words)) as size
            from (select *, unnest(range(1, greatest(len(words) - 10, 0) + 2)) as i from item where len(words) > 0)),
        document as (
            select doc_id, row_number() over () as r,
                coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as words
            from documents),
        place as (
            select r, size, i, array_to_string(words[i : i + size - 1], ' ') as span
            from (select r, words, size, unnest(range(1, len(words) - size + 2)) as i
                from document, (select distinct size from item_window) where len(words) >= size)),
        found as (select r, i, size, item from place join item_window using (span, size)),
        hit as (select r, count(distinct w) as n_hit from
            (select r, unnest(range(i, i + size)) as w from found) group by r),
        named as (
            select r, count(distinct item) as n_items, array_to_string(list_sort(list(distinct item)), ',') as items
            from found group by r)
        select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
            coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
            coalesce(n_hit, 0) > 0 as contaminated
        from document left join hit using (r) left join named using (r)
    """,
    "op9_substring_dedup": """
        with document as (
            select doc_id, row_number() over () as r, len(words) as n, words
            from (select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as words
                from documents)),
        place as (
            select r, doc_id, i, sha256(array_to_string(words[i : i + 12], ' ')) as span
            from (select *, unnest(range(1, n - 11)) as i from document where n >= 13)),
        repeated as (
            select r, i from (select *, min(doc_id) over (partition by span) as first_doc from place)
            where doc_id > first_doc),
        gone as (select distinct r, unnest(range(i, i + 13)) as w from repeated),
        kept as (
            select r, string_agg(word, ' ' order by w) as text, count(*) as n_kept
            from (select r, unnest(words) as word, unnest(range(1, n + 1)) as w from document)
            anti join gone using (r, w) group by r)
        select doc_id, cast(n as bigint) as n_words, cast(n - coalesce(n_kept, 0) as bigint) as n_removed,
            sha256(coalesce(text, '')) as kept_sha256
        from document left join kept using (r)
    """,
    "op11_fill_in_middle": r"""
        with document as (
            select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as units,
                sha256('7:' || coalesce(cast(doc_id as varchar), '')) as digest
            from documents),
        drawn as (
            select *, cast(len(units) as bigint) as n, cast('0x' || digest[1:8] as bigint) as h1,
                cast('0x' || digest[9:16] as bigint) as h2, cast('0x' || digest[17:24] as bigint) as h3,
                cast('0x' || digest[25:32] as bigint) as h4
            from document),
        cut as (
            select *, least(h1 % (n + 1), h2 % (n + 1)) as i, greatest(h1 % (n + 1), h2 % (n + 1)) as j,
                case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                    or h3 % 100 >= 100 then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end as form
            from drawn),
        part as (
            select *, array_to_string(units[1 : i], '') as prefix, array_to_string(units[i + 1 : j], '') as middle,
                array_to_string(units[j + 1 :], '') as suffix
            from cut)
        select doc_id, n, form,
            case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
            case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
            sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
            sha256(text) as restored_sha256
        from part
    """,
    "op13_source_divergence": r"""
        with document as (
            select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as r,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as words
            from documents),
        word as (select r, lang, source, unnest(words) as term from document),
        kept as (select lang, term, count(*) as n from word group by lang, term having count(distinct r) >= 10),
        counted as (
            select lang, source, term, w.n from (select lang, source, term, count(*) as n from word group by all) as w
            join kept using (lang, term)),
        total as (select lang, count(*) as v, sum(n) as n from kept group by lang),
        cohort as (
            select g.lang, g.source, coalesce(t.v, 0) as v, coalesce(c.n, 0) as n
            from (select distinct lang, source from document) as g
            left join (select lang, source, sum(n) as n from counted group by all) as c using (lang, source)
            left join total as t using (lang)),
        cell as (
            select g.lang, g.source, k.term, c.n is not null as occurs,
                1 + (cast(1000000000 as hugeint) * (coalesce(c.n, 0) + 2)) // (g.n + 2 * g.v) as p,
                1 + (cast(1000000000 as hugeint) * (k.n + 2)) // (t.n + 2 * t.v) as q
            from cohort as g join kept as k using (lang) join total as t using (lang)
            left join counted as c on c.lang = g.lang and c.source = g.source and c.term = k.term),
        pair as (
            select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value
            from cell as a join cell as b using (lang, term) where a.source <> b.source group by all
            union all
            select a.lang, a.source, b.source, 0 from cohort as a join cohort as b using (lang)
            where a.v = 0 and a.source <> b.source),
        term as (
            select lang, source, term as item, ((p - q) * (p - q)) // (p + q) as value from cell where occurs and p > q),
        ranked as (
            select 'pair' as part, *, row_number() over (partition by lang, source order by value desc, item) as place
            from pair
            union all
            select 'term', *, row_number() over (partition by lang, source order by value desc, item) from term)
        select lang, source, part, item, cast(value as bigint) as value, cast(place as integer) as rank
        from ranked where part = 'pair' or place <= 10
    """,
}
