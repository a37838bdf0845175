"""URL filter: list rules by host and path first, a weighted vocabulary for the rest.

An Aho-Corasick automaton finds all strict and soft terms in one pass over the address. A hit counts only between
boundaries (no letter or digit before or after it). One strict term blocks; soft terms block when there are several
distinct ones and their weights together reach a limit. One soft term alone never blocks, however heavy or often.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The rules of the contract, as (verdict, rule).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: One of these blocks.
STRICT = (
    "camgirls", "escorts", "hardcore", "hentai", "keygen", "malware", "milf", "pedo", "phishing", "porn", "porno",
    "pornos", "pornstar", "ransomware", "sexcam", "sexcams", "warez", "webcamsex", "xxx", "youporn",
)
#: Several of these block by weight: gambling, pills, loans, adult pages, copies and spam, in the languages at hand.
SOFT = {
    "adult": 1, "apuestas": 1, "besplatno": 1, "betting": 1, "bonus": 1, "casino": 1, "cheap": 1, "cialis": 2,
    "clickbait": 1, "coupon": 1, "crack": 1, "cracked": 1, "credito": 1, "dating": 1, "descargar": 1, "diet": 1, "erotic": 2,
    "erotik": 2, "erotique": 2, "escort": 2, "fetish": 2, "free": 1, "gambling": 1, "gratis": 1, "gratuit": 1, "jackpot": 1,
    "kostenlos": 1, "kredit": 1, "levitra": 2, "loans": 1, "lottery": 1, "mortgage": 1, "naked": 2, "nude": 2, "nudes": 2,
    "nulled": 2, "payday": 1, "pharmacy": 1, "pills": 1, "pirate": 1, "poker": 1, "prestamos": 1, "replica": 1,
    "rezeptfrei": 2, "roulette": 1, "seo": 1, "serial": 1, "sex": 2, "sexe": 2, "sexo": 2, "sexy": 2, "slots": 1, "spins": 1,
    "steroids": 2, "streaming": 1, "torrent": 1, "torrents": 1, "tramadol": 2, "viagra": 2, "weightloss": 1, "wetten": 1,
}
SOFT_LIMIT = 2
#: Distinct soft terms there must be.
SOFT_TERMS = 2


def automaton(strict: tuple[str, ...], soft: dict[str, int]) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for term in strict:
        out.add_word(term, (term, 0))
    for term, weight in soft.items():
        out.add_word(term, (term, weight))
    out.make_automaton()
    return out


def lower(text: str) -> str:
    """A-Z lower-cased, nothing else."""
    return text.translate(_LOWER)


_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def word_char(c: str) -> bool:
    return "a" <= c <= "z" or "0" <= c <= "9"


def terms_in(url: str, terms: ahocorasick.Automaton) -> tuple[int, int, int]:
    """How many distinct strict and soft terms are found, and the weight of the soft ones."""
    text, found = lower(url), {}
    for last, (term, weight) in terms.iter(text):
        start = last + 1 - len(term)
        if (start and word_char(text[start - 1])) or (last + 1 < len(text) and word_char(text[last + 1])):
            continue
        found[term] = weight
    soft = sum(1 for w in found.values() if w)
    return len(found) - soft, soft, sum(found.values())


def split_url(url: str | None) -> tuple[str, str]:
    """Host, with A-Z lower-cased, and path; both empty without ``://``."""
    _, there, rest = (url or "").partition("://")
    if not there:
        return "", ""
    end = min((k for k in map(rest.find, "?#") if k >= 0), default=len(rest))
    slash = rest.find("/", 0, end)
    host_end = slash if slash >= 0 else end
    return lower(rest[:host_end]), rest[host_end:end]


def matching_rule(host: str, path: str, rules: dict[str, list[tuple[str, str, str]]]) -> tuple[str | None, str | None]:
    """The longest rule that fits a host and path, and its verdict. ``rules``: by rule host, longest path first."""
    best: tuple[str | None, str | None] = (None, None)
    name = host
    while name:
        for verdict, rule, start in rules.get(name, ()):
            if path.startswith(start) and len(rule) > len(best[0] or ""):
                best = (rule, verdict)
        name = name.partition(".")[2]
    return best


RESULT = "page_id bigint, host string, path string, rule string, verdict string, strict_hits bigint, soft_hits bigint, soft_weight bigint"


def url_verdicts(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT, soft_limit=SOFT_LIMIT, soft_terms=SOFT_TERMS) -> DataFrame:
    """One row for each row of ``pages`` (page_id, url): host, path, the longest fitting rule, and the verdict.

    Null urls and urls without ``://`` have empty host and path, so no rule, but their text is still searched for
    terms (a null has none and is allowed). Each row is judged alone, in one pass without a shuffle, so repeated rows get
    equal verdicts; urls of any length are searched whole. An empty table gives no rows; other columns aren't looked at.
    """
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for verdict, rule in rules:
        host, _, path = rule.partition("/")
        by_host.setdefault(host, []).append((verdict, rule, "/" + path))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = automaton(strict, soft)
        for batch in batches:
            out = []
            for page_id, url in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), strict=True):
                host, path = split_url(url)
                rule, verdict = matching_rule(host, path, by_host)
                hard, mild, weight = terms_in(url or "", terms)
                verdict = verdict or ("block" if hard or (mild >= soft_terms and weight >= soft_limit) else "allow")
                out.append((page_id, host, path, rule, verdict, hard, mild, weight))
            columns = list(zip(*out, strict=True)) if out else [[]] * 8
            kinds = [pa.int64(), *[pa.string()] * 4, *[pa.int64()] * 3]
            names = ["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits", "soft_weight"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return pages.select(F.col("page_id").cast("bigint"), "url").mapInArrow(judge, RESULT)


def allowed(pages: DataFrame, **options) -> DataFrame:
    """The verdict rows of pages that may be kept."""
    return url_verdicts(pages, **options).where("verdict = 'allow'")


def _oracle() -> str:
    fits = " union all ".join(
        f"select '{rule}' as rule, '{verdict}' as verdict, '{rule.partition('/')[0]}' as rh, '/{rule.partition('/')[2]}' as rp"
        for verdict, rule in RULES
    )
    edge = lambda t: f"regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')"
    hard = " + ".join(f"{edge(t)}::bigint" for t in STRICT)
    mild = " + ".join(f"{edge(t)}::bigint" for t in SOFT)
    weight = " + ".join(f"{w} * {edge(t)}::bigint" for t, w in SOFT.items())
    return f"""
with rules as ({fits}),
parts as (
  select page_id, url,
    case when contains(url, '://') then regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*') else '' end as raw_host,
    case when contains(url, '://') then regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) else '' end as path,
    translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low
  from pages),
hosts as (
  select *, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    {hard} as strict_hits, {mild} as soft_hits, {weight} as soft_weight
  from parts),
best as (
  select h.*, (select arg_max(struct_pack(rule := r.rule, verdict := r.verdict), length(r.rule)) from rules r
     where (h.host = r.rh or ends_with(h.host, '.' || r.rh)) and starts_with(h.path, r.rp)) as b
  from hosts h)
select page_id, host, path, b.rule as rule,
  coalesce(b.verdict, case when strict_hits > 0 or (soft_hits >= {SOFT_TERMS} and soft_weight >= {SOFT_LIMIT}) then 'block' else 'allow' end) as verdict,
  strict_hits, soft_hits, soft_weight
from best"""


ORACLE = _oracle()
