"""Pieces of oracle SQL: expressions and common table expressions in DuckDB's dialect."""

from __future__ import annotations

import re

from brandlens.contract import (
    COUNTRY_SYNONYMS, KNOWN_PRICE_LABELS, LEGAL_FORMS, MISSING_WORDS, NA_WORDS,
)
from brandlens.sources.brands import brands_oracle

SPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
VISIBLE = r"[^\t-\r\x1c-\x20\x{85}\p{Z}]"
WORD = r"\p{L}\p{N}_"


def texts(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def squeeze(x: str) -> str:
    return f"regexp_replace({x}, '{SPACE}+', ' ', 'g')"


def basic(x: str) -> str:
    return f"coalesce({squeeze(f'replace(lower({strip(x)}), chr(8203), {chr(39)}{chr(39)})')}, '')"


def in_order(lst: str) -> str:
    """Distinct list items in first-seen order."""
    return f"list_filter({lst}, lambda x, i: list_position({lst}, x) = i)"


def clean_name(x: str) -> str:
    letters = f"regexp_replace({basic(x)}, '[^a-zа-яё0-9 ]', ' ', 'g')"
    kept = f"list_filter(string_split({letters}, ' '), lambda t: t <> '' and t not in ({texts(LEGAL_FORMS)}))"
    return f"array_to_string({in_order(kept)}, ' ')"


def country_key(x: str) -> str:
    return strip(squeeze(f"regexp_replace({basic(x)}, '[^{WORD} ,-]', '', 'g')"))


def country(x: str) -> str:
    whens = " ".join(f"when '{k}' then '{v}'" for k, v in COUNTRY_SYNONYMS.items())
    return f"case {country_key(x)} when '' then 'Неизвестно' {whens} else {strip(x)} end"


def domain(x: str) -> str:
    return f"coalesce(nullif({squeeze(strip(x))}, ''), 'Неизвестно')"


def domain_key(x: str) -> str:
    return strip(squeeze(f"regexp_replace({basic(x)}, '[^{WORD} ]', ' ', 'g')"))


def label_list(x: str) -> str:
    text = f"replace(replace(replace(replace(lower({strip(x)}), chr(8203), ''), chr(160), ' '), ',', ';'), ':', ';')"
    parts = f"list_filter(list_transform(string_split(coalesce({text}, ''), ';'), lambda p: {strip('p')}), lambda p: p <> '')"
    return in_order(parts)


def normal_labels(x: str) -> str:
    return f"coalesce(nullif(array_to_string({label_list(x)}, ';'), ''), 'неизвестно')"


def known_labels(x: str) -> str:
    return f"list_filter({label_list(x)}, lambda l: l in ({texts(KNOWN_PRICE_LABELS)}))"


def unexpected_labels(x: str) -> str:
    return f"list_filter({label_list(x)}, lambda l: l not in ({texts([*KNOWN_PRICE_LABELS, 'неизвестно'])}))"


def number(x: str) -> str:
    s = strip(x)
    pattern = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    value = f"try_cast({s} as double)"
    return f"case when regexp_full_match({s}, '{pattern}') and not isinf({value}) then {value} end"


def own(x: str) -> str:
    n = rf"regexp_extract_all({x}, '\p{{Nd}}+')"
    return (f"case when len({n}) = 0 then null when contains(lower({x}), 'франчайз') and len({n}) = 1 then 0.0::double "
            f"else {n}[1]::double end")


def franchise(x: str) -> str:
    n = rf"regexp_extract_all({x}, '\p{{Nd}}+')"
    return (f"case when len({n}) = 0 then null when not contains(lower({x}), 'франчайз') then 0.0::double "
            f"when len({n}) >= 2 then {n}[2]::double else {n}[1]::double end")


def item_count(x: str) -> str:
    return f"coalesce(len(list_filter(string_split({x}, ';'), lambda p: regexp_matches(p, '{VISIBLE}'))), 0)::int"


def word_count(x: str) -> str:
    return f"len(list_filter(regexp_split_to_array(coalesce({x}, ''), '{SPACE}+'), lambda w: w <> ''))::int"


def has_digit(x: str) -> str:
    return rf"coalesce(regexp_matches({x}, '\p{{Nd}}'), false)::int"


def year_mentions(x: str) -> str:
    return (rf"len(list_filter(regexp_split_to_array(coalesce({x}, ''), '[^{WORD}]+'), "
            rf"lambda w: regexp_full_match(w, '(18|19|20)\p{{Nd}}{{2}}')))::int")


def blank(x: str) -> str:
    return f"(not regexp_matches(coalesce({x}, ''), '{VISIBLE}'))"


def missing(x: str) -> str:
    return f"({x} is null or lower({strip(x)}) in ({texts(MISSING_WORDS)}))"


def na(x: str) -> str:
    return f"case when {x} not in ({texts(NA_WORDS)}) then {x} end"


def hash32(key: str) -> str:
    return f"cast(concat('0x', substr(md5({key}), 1, 8)) as bigint)"


def keyed(row_id: str, tag: str | int) -> str:
    return f"concat_ws('|', {row_id}, '{tag}')"


def unit(key: str) -> str:
    return f"({hash32(key)} / 4294967296.0::double)"


def inside(x: str, low: float, high: float) -> str:
    return f"greatest({float(low)}::double, least({x}, {float(high)}::double))"


CTES: dict[str, str] = {
    "brands_raw": brands_oracle(),
    "brands": "select * exclude (contry_origin), contry_origin as country_origin from brands_raw",
    "prep": f"""
select row_id, name, {clean_name('name')} as name_clean, {country('country_origin')} as country_origin,
  {domain('domain')} as domain, {normal_labels('price_category')} as price_category,
  {number('founded')} as founded, {number('presence_world')} as presence_world, presence_russia,
  {own('presence_russia')} as presence_own, {franchise('presence_russia')} as presence_franchise,
  presence_regions, {item_count('presence_regions')} as n_regions, description,
  length(coalesce(description, ''))::int as desc_len, {has_digit('description')} as desc_has_digits,
  {year_mentions('description')} as desc_year_mentions, {number('plans')} as plans,
  {number('total_rented_area')} as total_rented_area,
  ({number('total_rented_area')} is not null)::int as has_total_rented_area
from brands""",
    "known_domain": f"select * from prep where {strip('domain')} not in ('', 'Неизвестно')",
    "domain_rows": "select * from known_domain where domain in "
                   "(select domain from known_domain group by domain having count(*) >= 5)",
    "founded_rows": "select * from prep where founded between 1850 and 2025",
    "price_all": f"select *, {known_labels('price_category')} as labels from prep",
    "price_rows": "select * from price_all where len(labels) > 0",
}


def need(select: str, found: list[str] | None = None) -> list[str]:
    """Names of the CTEs a SELECT uses, dependencies first."""
    found = [] if found is None else found
    for name, text in CTES.items():
        if name not in found and re.search(rf"\b{name}\b", select):
            need(text, found)
            if name not in found:
                found.append(name)
    return found


def sql(select: str) -> str:
    """A SELECT with the CTEs it uses."""
    names = need(select)
    if not names:
        return select
    return "with " + ",\n".join(f"{n} as materialized ({CTES[n]})" for n in names) + "\n" + select
