"""DuckDB SQL with the same results as the registered queries, where SQL can state them."""

from __future__ import annotations

from tallyworks.llm import chat, collocations, decontaminate, divergence, imatch, mixing, repeats
from tallyworks.llm.common import ALNUM_WORD, SPACED_WORD


def hash_fraction(text: str) -> str:
    return f"(('0x' || substr(md5({text}), 1, 13))::BIGINT / {float(2**52)!r}::DOUBLE)"


def chat_snapshots() -> str:
    opening, middle, closing = (
        " || ".join(f"'{part}'" if part else "chr(10)" for part in parts)
        for parts in (["<|im_start|>"], [""], ["<|im_end|>", ""])
    )
    return f"""
WITH turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations)),
whole AS (
  SELECT conv_id, list(struct_pack(role, text) ORDER BY place) AS said FROM turns GROUP BY conv_id),
smallest AS (SELECT said, min(conv_id) AS conv_id FROM whole GROUP BY said),
kept AS (
  SELECT conv_id, len(said) AS n_turns FROM smallest a
  WHERE NOT EXISTS (
    SELECT 1 FROM smallest b
    WHERE b.said[1] = a.said[1] AND len(b.said) > len(a.said)
      AND b.said[1:len(a.said)] = a.said))
SELECT t.conv_id, ((place - 1) // {chat.BLOCK})::BIGINT AS part, any_value(n_turns)::BIGINT AS n_turns,
       string_agg({opening} || role || {middle} || text || {closing}, '' ORDER BY place) AS rendered
FROM turns t JOIN kept ON t.conv_id IS NOT DISTINCT FROM kept.conv_id
GROUP BY t.conv_id, part"""


def source_mixing(seed: str = "mix") -> str:
    weights = f"[{', '.join(map(str, mixing.WEIGHTS))}]"
    return f"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(doc_id::VARCHAR, ':' || coalesce(source, '') || ':' || coalesce(text, '')) AS name,
         len(regexp_extract_all(coalesce(text, ''), '{SPACED_WORD}'))::BIGINT AS size
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, {weights}[((row_number() OVER (ORDER BY source NULLS LAST) - 1)
                       % {len(mixing.WEIGHTS)} + 1)::INT] AS weight
  FROM sources),
levels AS (
  SELECT *, ({mixing.SHARE}::DOUBLE * (sum(source_size) OVER ())::DOUBLE
             - ({mixing.LIMIT} * coalesce(sum(source_size) OVER caps, 0))::DOUBLE)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER caps, 0))::DOUBLE AS level
  FROM weighted
  WINDOW caps AS (ORDER BY source_size::DOUBLE / weight::DOUBLE, source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         least(weight::DOUBLE * max(level) OVER (),
               ({mixing.LIMIT} * source_size)::DOUBLE) AS target
  FROM levels),
rated AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0.0 END AS rate,
         {hash_fraction(f"'{seed}:' || name")} AS draw
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate)::BIGINT + (draw < rate - floor(rate))::BIGINT))::BIGINT AS taken
FROM rated"""


def imatch_fingerprints() -> str:
    def terms(text: str) -> str:
        return f"list_distinct(regexp_extract_all(lower({text}), '{ALNUM_WORD}'))"

    def signed(codes: str) -> str:
        return (
            f"CASE WHEN len({codes}) > 0 THEN substr(md5(array_to_string({codes}, ',')), 1, 8) "
            f"ELSE '{imatch.EMPTY}' END"
        )

    subsets = ["codes"]
    offset = 0
    for bits in imatch.SUBSET_BITS:
        subsets.append(f"list_filter(codes, lambda c: ((c >> {offset}) & {2**bits - 1}) = 0)")
        offset += bits
    signatures = ", ".join(signed(codes) for codes in subsets)
    return f"""
WITH placed AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n_chars,
         row_number() OVER (ORDER BY doc_id DESC NULLS LAST, text NULLS FIRST) AS place
  FROM documents),
pairs AS (
  SELECT p.*, n.text AS next_text, n.place AS next_place,
         substring(p.text, 1, p.n_chars - p.n_chars // 2)
         || substring(n.text, 1, p.n_chars // 2) AS edited
  FROM placed p JOIN placed n
    ON n.place = CASE WHEN p.place = (SELECT count(*) FROM placed) THEN 1 ELSE p.place + 1 END),
counts AS (
  SELECT term, count(*) AS documents_with
  FROM (SELECT unnest({terms("text")}) AS term FROM placed) GROUP BY term),
lexicon AS (
  SELECT term, ('0x' || substr(md5(term), 1, 15))::BIGINT AS code FROM counts
  WHERE ln((SELECT count(*) FROM placed)::DOUBLE / documents_with)
        BETWEEN {imatch.IDF_LOW} AND {imatch.IDF_HIGH}),
versions AS (
  SELECT place, 0 AS kind, {terms("text")} AS terms FROM pairs
  UNION ALL SELECT place, 1, {terms("edited")} FROM pairs),
hits AS (
  SELECT place, kind, list_sort(list(DISTINCT code)) AS codes
  FROM (SELECT place, kind, unnest(terms) AS term FROM versions) JOIN lexicon USING (term)
  GROUP BY place, kind),
marked AS (
  SELECT versions.place, versions.kind,
         CASE WHEN codes IS NULL
              THEN list_transform(range({1 + len(imatch.SUBSET_BITS)}), lambda i:
                   substr(md5(array_to_string(list_sort(terms), ' ')), 1, 8))
              ELSE [{signatures}] END AS marks
  FROM versions LEFT JOIN hits USING (place, kind)),
compared AS (
  SELECT p.doc_id, p.n_chars, sha256(p.edited) AS edited_sha256,
         a.marks AS mine, e.marks AS edited, n.marks AS following
  FROM pairs p
  JOIN marked a ON a.place = p.place AND a.kind = 0
  JOIN marked e ON e.place = p.place AND e.kind = 1
  JOIN marked n ON n.place = p.next_place AND n.kind = 0)
SELECT doc_id, n_chars, edited_sha256, array_to_string(mine, '') AS fingerprint,
       array_to_string(edited, '') AS edited_fingerprint,
       {_likeness("mine", "edited")} AS near_edited,
       {_likeness("mine", "following")} AS near_next
FROM compared"""


def _likeness(left: str, right: str) -> str:
    places = f"range(1, {2 + len(imatch.SUBSET_BITS)})"
    equal = f"{left}[i] = {right}[i]"
    blank = f"{left}[i] = '{imatch.EMPTY}'"
    return (
        f"len(list_filter({places}, lambda i: {equal} AND NOT ({blank})))::DOUBLE / "
        f"len(list_filter({places}, lambda i: NOT ({equal} AND {blank})))::DOUBLE"
    )


def benchmark_decontamination() -> str:
    def words(column: str) -> str:
        lower = f"translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return f"regexp_extract_all(coalesce({lower}, ''), '{ALNUM_WORD}')"

    size = decontaminate.WINDOW
    return f"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS row, {words("text")} AS words FROM documents),
items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, {words("text")} AS words
  FROM benchmark WHERE text IS NOT NULL),
phrases AS (
  SELECT DISTINCT item, words[i:i + {size - 1}] AS phrase
  FROM (SELECT item, words, unnest(range(1, greatest(2, len(words) - {size} + 2))) AS i
        FROM items WHERE len(words) > 0)),
lengths AS (SELECT DISTINCT len(phrase) AS size FROM phrases),
hits AS (
  SELECT row, place, size, item
  FROM (SELECT row, size, unnest(range(1, len(words) - size + 2)) AS place, words
        FROM docs, lengths WHERE len(words) >= size) windows
  JOIN phrases ON phrases.phrase = words[place:place + size - 1]),
covered AS (
  SELECT row, count(DISTINCT word) AS n_hit
  FROM (SELECT row, unnest(range(place, place + size)) AS word FROM hits) GROUP BY row),
named AS (
  SELECT row, count(DISTINCT item) AS n_items,
         string_agg(DISTINCT item, ',' ORDER BY item) AS names
  FROM hits GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (row) LEFT JOIN named USING (row)"""


def lowered(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def source_divergence(min_documents: int = divergence.MIN_DOCUMENTS) -> str:
    def probability(count: str, total: str, terms: str) -> str:
        above = f"({divergence.UNIT}::HUGEINT * ({count} + {divergence.PRIOR}))"
        return f"(1 + {above} // ({total} + {divergence.PRIOR} * {terms})::HUGEINT)"

    return f"""
WITH read AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({lowered("coalesce(text, '')")},
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
words AS (SELECT row, lang, source, unnest(terms) AS term FROM read),
vocabulary AS (
  SELECT lang, term FROM words GROUP BY lang, term
  HAVING count(DISTINCT row) >= {min_documents}),
sizes AS (SELECT lang, count(*) AS terms FROM vocabulary GROUP BY lang),
kept AS (SELECT words.* FROM words JOIN vocabulary USING (lang, term)),
groups AS (
  SELECT lang, source, coalesce(any_value(sizes.terms), 0) AS terms
  FROM read LEFT JOIN sizes USING (lang) GROUP BY lang, source),
totals AS (SELECT lang, source, count(*) AS total FROM kept GROUP BY lang, source),
lang_totals AS (SELECT lang, count(*) AS total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM kept GROUP BY lang, source, term),
lang_counts AS (SELECT lang, term, count(*) AS n FROM kept GROUP BY lang, term),
dense AS (
  SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n,
         {probability("coalesce(c.n, 0)", "coalesce(t.total, 0)", "g.terms")} AS p,
         {probability("lc.n", "lt.total", "g.terms")} AS q
  FROM groups g JOIN vocabulary v USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  JOIN lang_counts lc ON lc.lang = g.lang AND lc.term = v.term
  JOIN lang_totals lt ON lt.lang = g.lang),
distances AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM dense WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM found QUALIFY part = 'pair' OR rank <= {divergence.TOP_TERMS}"""


def phrase_collocations(support: int = collocations.SUPPORT) -> str:
    counted = " UNION ALL ".join(
        f"""
  SELECT lang, {size} AS size,
         unnest(list_transform(range(1, len(words) - {size - 2}), lambda i: {
            " || ' ' || ".join(f"words[i + {more}]" for more in range(size))})) AS phrase
  FROM pieces WHERE len(words) >= {size}"""
        for size in range(1, collocations.LONGEST + 1)
    )
    return f"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array({lowered("coalesce(text, '')")},
                                         '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang),
counts AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM ({counted}) GROUP BY lang, size, phrase),
candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS words FROM counts
  WHERE size > 1 AND f >= {support}),
cuts AS MATERIALIZED (
  SELECT lang, size, phrase, a, cut, array_to_string(words[1:cut], ' ') AS opening,
         array_to_string(words[cut + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS cut FROM candidates)),
scores AS (
  SELECT c.lang, c.size, c.phrase, c.a, l.f AS l, r.f AS r,
         (1000000::HUGEINT * c.a * c.a // (l.f::HUGEINT * r.f))::BIGINT AS score, cut
  FROM cuts c
  JOIN counts l ON l.lang = c.lang AND l.phrase = c.opening
  JOIN counts r ON r.lang = c.lang AND r.phrase = c.rest),
best AS (
  SELECT * FROM scores
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
around AS (
  SELECT lang, phrase, max(a) AS a
  FROM (SELECT lang, a, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS phrase
        FROM candidates WHERE size = 3)
  GROUP BY lang, phrase)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, b.a DESC, phrase) AS rank,
       phrase, b.a, l, r, n, score
FROM best b JOIN totals USING (lang) LEFT JOIN around USING (lang, phrase)
WHERE coalesce(100 * around.a < {collocations.COVERING} * b.a, true) OR size > 2
QUALIFY rank <= {collocations.TOP}"""


def suffix_array_dedup(size: int = repeats.LENGTH) -> str:
    return f"""
WITH texts AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS row, hex(encode(coalesce(text, ''))) AS digits,
         (strlen(coalesce(text, '')))::BIGINT AS n_bytes
  FROM documents),
strings AS MATERIALIZED (
  SELECT row, start, md5_number(substr(digits, 2 * start + 1, {2 * size})) AS string
  FROM (SELECT row, digits, unnest(range(n_bytes - {size - 1})) AS start
        FROM texts WHERE n_bytes >= {size})),
twice AS (SELECT string FROM strings GROUP BY string HAVING count(*) > 1),
marked AS (SELECT row, start FROM strings SEMI JOIN twice USING (string)),
runs AS (
  SELECT row, start, sum(opens) OVER (PARTITION BY row ORDER BY start) AS run
  FROM (SELECT row, start,
               (start > coalesce(lag(start) OVER (PARTITION BY row ORDER BY start), -{size + 1})
                + {size})::INT AS opens FROM marked)),
spans AS (
  SELECT row, min(start) AS first, max(start) + {size} AS last,
         lag(max(start) + {size}, 1, 0) OVER (PARTITION BY row ORDER BY run) AS previous
  FROM runs GROUP BY row, run),
cut AS (
  SELECT row, sum(last - first)::BIGINT AS n_removed, count(*) AS n_spans,
         string_agg(substr(digits, 2 * previous + 1, 2 * (first - previous)), '' ORDER BY first) AS kept,
         max(last) AS done
  FROM spans JOIN texts USING (row) GROUP BY row)
SELECT doc_id, n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(digits, 2 * coalesce(done, 0) + 1))) AS kept_sha256
FROM texts LEFT JOIN cut USING (row)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_chat_snapshots": chat_snapshots(),
        "op4_imatch_fingerprints": imatch_fingerprints(),
        "op5_source_mixing": source_mixing(),
        "op10_benchmark_decontamination": benchmark_decontamination(),
        "op11_source_divergence": source_divergence(),
        "op12_phrase_collocations": phrase_collocations(),
        "op13_suffix_array_dedup": suffix_array_dedup(),
    }
