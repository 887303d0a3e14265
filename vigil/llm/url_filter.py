"""URL filter over a sorted digest array.

Every rule is stored once as a 64-bit xxhash key in one sorted array, with the
rule's full string beside it. Tasks memory-map the array, probe it with a
vectorised binary search for all (host suffix, path prefix) pairs a url can
match, and confirm every hit against the stored string, so a digest collision
can never decide a url.
"""

from __future__ import annotations

import hashlib
import os
import sys
import tempfile

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.session import ship_by_value

#: Bytes of stored rules in one array, about; a longer rule list makes several arrays.
PART_BYTES = 256 * 1024 * 1024
#: Separates host and path in a stored key; it cannot occur in a host.
_SEP = "\n"


def _array(entries: list[tuple[int, str, str]]) -> bytes:
    """Entries (digest, key, verdict), sorted, as one byte string: counts, path lengths and label
    counts that occur, keys, offsets and the stored strings."""
    stored = [f"{v}{_SEP}{k}".encode() for _, k, v in entries]
    ends = np.cumsum([len(s) for s in stored], dtype=np.int64) if stored else np.zeros(0, np.int64)
    parts = [k.partition(_SEP) for _, k, _ in entries]
    lengths = np.array(sorted({len(p) for _, _, p in parts}), dtype=np.int64)
    labels = np.array(sorted({h.count(".") + 1 for h, _, _ in parts}), dtype=np.int64)
    head = np.array([len(entries), len(lengths), len(labels)], dtype=np.int64)
    keys = np.array([e[0] for e in entries], dtype=np.uint64)
    return head.tobytes() + lengths.tobytes() + labels.tobytes() + keys.tobytes() + ends.tobytes() + b"".join(stored)


def build_index(rules: list[tuple[str, str, str]], part_bytes: int = PART_BYTES) -> list[bytes]:
    """(host, path, verdict) rules to sorted digest arrays, each a byte string of about
    ``part_bytes`` at most; however many rules there are, none is left out. Of repeated (host,
    path) rules the last one holds."""
    table = {f"{h}{_SEP}{p}": v for h, p, v in rules}
    entries = sorted((xxhash.xxh64_intdigest(k), k, v) for k, v in table.items())
    out, part, held = [], [], 0
    for e in entries:
        if part and held > part_bytes:
            out.append(_array(part))
            part, held = [], 0
        part.append(e)
        held += len(e[1]) + len(e[2]) + 16
    return [*out, _array(part)]


class DigestArray:
    """A memory-mapped index; ``find`` takes many keys at once."""

    def __init__(self, path: str):
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        n, m, k = (int(x) for x in raw[:24].view(np.int64))
        at = 24
        self.lengths = [int(x) for x in raw[at:at + 8 * m].view(np.int64)]
        at += 8 * m
        self.labels = [int(x) for x in raw[at:at + 8 * k].view(np.int64)]
        at += 8 * k
        self.keys = raw[at:at + 8 * n].view(np.uint64)
        at += 8 * n
        self.ends = raw[at:at + 8 * n].view(np.int64)
        self.stored = raw[at + 8 * n:]

    def find(self, keys: list[str]) -> list[str | None]:
        """The verdict of each key, or None."""
        out: list[str | None] = [None] * len(keys)
        if not keys or not len(self.keys):
            return out
        digests = np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), dtype=np.uint64, count=len(keys))
        at = np.searchsorted(self.keys, digests)
        ok = at < len(self.keys)
        ok[ok] = self.keys[at[ok]] == digests[ok]
        for i in np.flatnonzero(ok):
            j = int(at[i])
            while j < len(self.keys) and self.keys[j] == digests[i]:
                start = int(self.ends[j - 1]) if j else 0
                verdict, _, key = bytes(self.stored[start:int(self.ends[j])]).decode().partition(_SEP)
                if key == keys[i]:
                    out[i] = verdict
                    break
                j += 1
        return out


def open_index(payload: bytes) -> DigestArray:
    """Map the payload from a file of this executor, which its tasks share; written once, by
    rename, and taken again only if it holds the payload."""
    path = os.path.join(tempfile.gettempdir(), f"digests-{hashlib.sha256(payload).hexdigest()[:32]}.bin")
    try:
        with open(path, "rb") as f:
            same = f.read() == payload
    except OSError:
        same = False
    if not same:
        fd, part = tempfile.mkstemp(dir=tempfile.gettempdir())
        with os.fdopen(fd, "wb") as f:
            f.write(payload)
        os.replace(part, path)
    return DigestArray(path)


def host_suffixes(host: str, labels: list[int]) -> list[str]:
    """The host and those parent domains that have one of these numbers of labels."""
    dots = host.count(".") + 1
    return [host if n == dots else host.split(".", dots - n)[-1] for n in labels if n <= dots]


def judge(arrays: list[DigestArray], hosts, paths) -> tuple[list[str | None], list[str | None]]:
    """The longest fitting rule (host + path) of each url, and its verdict. Of
    equally long rules the one with the longer host counts."""
    rules: list[str | None] = [None] * len(hosts)
    verdicts: list[str | None] = [None] * len(hosts)
    best = [(-1, -1)] * len(hosts)
    for index in arrays:
        probes: list[str] = []
        owner: list[int] = []
        rule_text: list[tuple[str, int]] = []
        cache: dict[str, list[str]] = {}
        for i, (h, p) in enumerate(zip(hosts, paths)):
            if h not in cache:
                cache[h] = host_suffixes(h, index.labels)
            for s in cache[h]:
                for n in index.lengths:
                    if n <= len(p):
                        probes.append(f"{s}{_SEP}{p[:n]}")
                        owner.append(i)
                        rule_text.append((s + p[:n], len(s)))
        for i, (rule, host_len), v in zip(owner, rule_text, index.find(probes)):
            if v is not None and (len(rule), host_len) > best[i]:
                best[i], rules[i], verdicts[i] = (len(rule), host_len), rule, v
    return rules, verdicts


def split_url(df: DataFrame, url_col: str = "url") -> DataFrame:
    """``df`` with _host (ASCII lower case) and _path; both empty if the url is
    null or holds no ``://``."""
    url = F.coalesce(F.col(f"`{url_col}`"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    no_query = F.regexp_extract(rest, r"(?s)^[^?#]*", 0)
    host = F.translate(F.regexp_extract(no_query, r"(?s)^[^/]*", 0),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return df.withColumn("_host", host).withColumn("_path", F.regexp_extract(no_query, r"(?s)^[^/]*(.*)$", 1))


def filter_urls(df: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow",
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict of every row; ``default`` where no rule fits.

    Null urls and urls without ``://`` have empty host and path, fit no rule with
    a host and take the default. Repeated rows give repeated results; an empty
    table or rule list is fine.
    """
    light = split_url(df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{url_col}`").alias("_url")), "_url") \
        .select("_id", "_host", "_path")
    index = df.sparkSession.sparkContext.broadcast(build_index(rules))
    kind = light.schema["_id"].dataType.simpleString()

    def run(batches):
        table = [open_index(part) for part in index.value]
        for b in batches:
            rule, verdict = judge(table, b["_host"].tolist(), b["_path"].tolist())
            yield pd.DataFrame({"id": b["_id"], "host": b["_host"], "path": b["_path"],
                                "rule": pd.Series(rule, dtype=object, index=b.index),
                                "verdict": pd.Series([v or default for v in verdict], dtype=object, index=b.index)})

    out = light.mapInPandas(run, f"id {kind}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("id", id_col)


#: The contract's rules.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

URL_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
n AS (SELECT page_id, regexp_extract(rest, '(?s)^[^?#]*', 0) AS r FROM u),
h AS (SELECT page_id, translate(regexp_extract(r, '(?s)^[^/]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(r, '(?s)^[^/]*(.*)$', 1) AS path FROM n),
rules(rh, rp, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (SELECT h.page_id, h.host, h.path, rh || rp AS rule, v,
        row_number() OVER (PARTITION BY h.page_id, h.host, h.path ORDER BY length(rh || rp) DESC, length(rh) DESC) AS k
      FROM h JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT h.page_id, h.host, h.path, m.rule, coalesce(m.v, 'allow') AS verdict
FROM h LEFT JOIN (SELECT DISTINCT page_id, host, path, rule, v FROM m WHERE k = 1) m USING (page_id, host, path)"""

ship_by_value(sys.modules[__name__])
