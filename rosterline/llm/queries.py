"""The registered queries of this subpackage, each applying one operator to the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    chosenpath, collocations, convtrie, exact, idstore, packing, pii, quality, repeats, sentencepieces, sharding, simhash,
    triecounts)
from .common import documents

Query = Callable[[SparkSession, str], DataFrame]


def over_documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "op1_jump_sharding": over_documents(sharding.shard_table),
    "op2_sentencepiece": over_documents(sentencepieces.piece_digests),
    "op3_difference_packing": over_documents(packing.packed_pieces),
    "op4_trie_token_counts": over_documents(triecounts.token_counts),
    "op5_rule_ledger": over_documents(quality.verdicts),
    "op6_simhash_ball": over_documents(simhash.near_duplicates),
    "op7_perfect_hash_store": over_documents(idstore.id_report),
    "op8_context_extraction": over_documents(pii.private_spans),
    "op9_suffix_dedup": over_documents(repeats.removal_report),
    "op10_exact_refinement": over_documents(exact.exact_groups),
    "op11_stripe_collocations": over_documents(collocations.collocations),
    "op12_conversation_trie": lambda spark, sf_dir: convtrie.conversation_trie(convtrie.conversations(spark, sf_dir)),
    "op13_chosen_path": over_documents(chosenpath.near_duplicates),
}
_WORD = r"[^\x20\x09-\x0D]"
_BIT = " + ".join(f"CASE WHEN {rule} THEN {quality.BITS[name]} ELSE 0 END" for name, rule in quality.RULES)

ORACLE: dict[str, str] = {
    "op5_rule_ledger": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{_WORD}+') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls FROM d),
g AS (SELECT doc_id, i, [ws[i], ws[i + 1], ws[i + 2]] AS g FROM (SELECT *, unnest(range(1, len(ws) - 1)) AS i FROM w)),
c AS (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM c WHERE n > 1) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(t, '{quality.SYMBOLS}')) AS BIGINT) AS n_symbols,
        CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN r USING (doc_id)),
f AS (SELECT *, CAST({_BIT} AS BIGINT) AS failures FROM m)
SELECT *, failures & {quality.BASE.mask} <> 0 AS base_failed,
  failures & {quality.BASE.mask | quality.CURRENT.mask} = 0 AS kept FROM f
""",
    "op10_exact_refinement": """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
""",
    # All phrases of all pieces, and all phrases within each longer candidate.
    "op11_stripe_collocations": f"""
WITH d AS (SELECT coalesce(lang, '{collocations.UNKNOWN}') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM d),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
s AS (SELECT lang, w, m.m AS m FROM p, range(1, {collocations.LONGEST + 1}) m(m) WHERE len(w) >= m.m),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM s)),
f AS (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= {collocations.LEAST}),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
i AS (SELECT lang, a, array_to_string(w[i:i + k - 1], ' ') AS phrase
      FROM (SELECT *, unnest(range(1, m - k + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS k FROM c))),
o AS (SELECT lang, phrase, max(a) AS most FROM i GROUP BY ALL),
r AS (SELECT c.* FROM c LEFT JOIN o USING (lang, phrase) WHERE o.most IS NULL OR 100 * o.most < {collocations.COVER} * c.a),
k AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
      FROM (SELECT *, unnest(range(1, m)) AS k FROM r)),
z AS (SELECT k.lang, k.phrase, k.a, x.a AS l, y.a AS r, n.n, k.k,
        CAST((CAST(1000 AS HUGEINT) * k.a * n.n) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
      FROM k JOIN n USING (lang) JOIN f x ON x.lang = k.lang AND x.phrase = k.x JOIN f y ON y.lang = k.lang AND y.phrase = k.y),
b AS (SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, CAST(row_number() OVER w AS BIGINT) AS rank, phrase, a, l, r, n, score FROM b
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY rank <= {collocations.TOP}
""",
}
