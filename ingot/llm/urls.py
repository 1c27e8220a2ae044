"""URL filters: host and path rules, then a weighted vocabulary.

The longest rule that fits the host (or a parent domain) and begins the path decides.  For the
others, one Aho-Corasick pass over the lower-cased URL finds the strict and soft terms that
stand between boundaries (no ASCII letter or digit on either side); one strict term or
``min_soft`` different soft terms reject.  Map-only; rules and terms are parameters that every
task holds.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from
there up to ``?``, ``#`` or the end.  Defined cases: a null url or one without ``://`` has empty
host and path, no rule, and is judged by its terms (null: allowed); of rules of equal length
the one with the longer host wins.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
STRICT = ["bestiality", "camgirl", "camgirls", "cumshot", "escorts", "hentai", "milf", "porn", "porno", "pornstar", "sexcam", "xvideos", "xxx"]
SOFT = ["adult", "babes", "bet", "betting", "cam", "casino", "crack", "dating", "escort", "fetish", "gambling", "hookup", "jackpot",
        "keygen", "lingerie", "lottery", "naked", "nude", "poker", "sex", "sexy", "slots", "torrent", "viagra", "warez", "webcam"]


def host_and_path(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((i for i in (rest.find(c) for c in "?#") if i >= 0), default=len(rest))
    rest = rest[:end]
    cut = rest.find("/")
    host, path = (rest, "") if cut < 0 else (rest[:cut], rest[cut:])
    return host.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"), path


def by_host(rules: list[tuple[str, str, str]]) -> dict[str, list[tuple[str, str]]]:
    out: dict[str, list[tuple[str, str]]] = {}
    for host, path, verdict in rules:
        out.setdefault(host, []).append((path, verdict))
    return out


def best_rule(host: str, path: str, rules: dict[str, list[tuple[str, str]]]) -> tuple[str, str] | None:
    """(rule, verdict) of the longest rule that fits."""
    best, at = None, 0
    while host:
        suffix = host[at:]
        for p, verdict in rules.get(suffix, ()):
            if path.startswith(p):
                key = (len(suffix) + len(p), len(suffix))
                if best is None or key > best[0]:
                    best = (key, suffix + p, verdict)
        at = host.find(".", at) + 1
        if not at:
            break
    return best[1:] if best else None


def automaton(strict: list[str], soft: list[str]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for kind, terms in (("soft", soft), ("strict", strict)):
        for t in terms:
            a.add_word(t, (kind, t))
    if len(a):
        a.make_automaton()
    return a


def hits(url: str, terms) -> tuple[set[str], set[str]]:
    """Strict and soft terms of the lower-cased url that stand between boundaries."""
    strict, soft = set(), set()
    word = "abcdefghijklmnopqrstuvwxyz0123456789"
    for end, (kind, t) in terms.iter(url) if len(terms) else ():
        start = end - len(t)
        if (start < 0 or url[start] not in word) and (end + 1 == len(url) or url[end + 1] not in word):
            (strict if kind == "strict" else soft).add(t)
    return strict, soft


SCHEMA = "host string, path string, rule string, verdict string, n_strict long, n_soft long"


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, strict=STRICT, soft=SOFT, min_soft: int = 2) -> DataFrame:
    """One row per page: its id, host, path, rule, verdict, n_strict, n_soft (different terms)."""
    small = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    id_field = f"page_id {small.schema['page_id'].dataType.simpleString()}, "

    def run(batches):
        own, terms = by_host(rules), automaton(strict, soft)
        for batch in batches:
            out = []
            for url in batch.column(1).to_pylist():
                host, path = host_and_path(url)
                rule = best_rule(host, path, own)
                a, b = hits((url or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"), terms)
                out.append((host, path, rule[0] if rule else None, rule[1] if rule else "block" if a or len(b) >= min_soft else "allow", len(a), len(b)))
            cols = list(zip(*out)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.string() if i < 4 else pa.int64()) for i, c in enumerate(cols))],
                                             names=["page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft"])

    return small.mapInArrow(run, id_field + SCHEMA)
