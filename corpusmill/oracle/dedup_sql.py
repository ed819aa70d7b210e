"""DuckDB forms of the MinHash / LSH / greedy-dedup operators (oracle only).

The signature is recomputed bit for bit (same sha1 token hash, same permutation
literals); the greedy scan is a recursive CTE walking rows in order and carrying
the band keys claimed by kept rows, so it needs no pair join either.
"""

from __future__ import annotations

from ..functions.charclass import WS
from ..operators.dedup import EMPTY_HASH, MERSENNE_P, NUM_PERM, PERM_SEED, optimal_bands, permutations
from .text_sql import lit


def token_hashes(x: str) -> str:
    toks = f"list_filter(string_split_regex({x}, {lit('[' + WS + ']+')}), lambda t: t <> '')"
    return f"list_distinct(list_transform({toks}, lambda t: ('0x' || substr(sha1(t), 1, 8))::BIGINT))"


def signature(hs: str, num_perm: int = NUM_PERM, seed: int = PERM_SEED) -> str:
    a, b = permutations(num_perm, seed)
    p = MERSENNE_P
    items = [
        f"coalesce(list_min(list_transform({hs}, lambda h: ({ai} * (h % {p}) + {bi}) % {p})), {EMPTY_HASH})"
        for ai, bi in zip(a, b)
    ]
    return f"CASE WHEN {hs} IS NULL THEN NULL ELSE [{', '.join(items)}] END"


def signature_select(source_sql: str, key: str, text: str) -> str:
    """SELECT key, signature (BIGINT[]) FROM source."""
    return (
        f"SELECT {key}, {signature('hs')} AS signature FROM "
        f"(SELECT {key}, {token_hashes(text)} AS hs FROM ({source_sql}) AS __src) AS __tok"
    )


def bands_select(sig_sql: str, key: str) -> str:
    """SELECT key, band (0-based), band_key (md5 hex) FROM the signatures."""
    nb, r = optimal_bands()
    parts = [
        f"SELECT {key}, {j} AS band, md5(array_to_string(list_slice(signature, {j * r + 1}, {(j + 1) * r}), ',')) AS band_key "
        f"FROM ({sig_sql}) AS __sig"
        for j in range(nb)
    ]
    return " UNION ALL ".join(parts)


def greedy_kept_select(bands_sql: str, key: str) -> str:
    """SELECT key of the rows kept by the sequential greedy scan (ascending ``key`` order)."""
    return f"""
SELECT o AS {key} FROM (
  WITH RECURSIVE
  b AS (SELECT {key} AS o, hash(band, band_key) AS k FROM ({bands_sql}) AS __b),
  seq AS (
    SELECT o, row_number() OVER (ORDER BY o) AS rn, list(k) AS ks FROM b GROUP BY o
  ),
  walk(rn, claimed, keep) AS (
    SELECT 0::BIGINT, []::UBIGINT[], false
    UNION ALL
    SELECT s.rn,
           CASE WHEN list_has_any(w.claimed, s.ks) THEN w.claimed ELSE list_concat(w.claimed, s.ks) END,
           NOT list_has_any(w.claimed, s.ks)
    FROM walk w JOIN seq s ON s.rn = w.rn + 1
  )
  SELECT seq.o FROM walk JOIN seq USING (rn) WHERE walk.keep
) AS __kept"""


def exact_first_select(source_sql: str, key: str, text: str) -> str:
    """Rows of ``source_sql`` that are the first (smallest ``key``) of their text."""
    return f"SELECT * FROM ({source_sql}) AS __x QUALIFY row_number() OVER (PARTITION BY {text} ORDER BY {key}) = 1"
