"""DuckDB SQL for the registered queries.

The SQL matches differently from the Spark side on purpose: it searches the
full ground alternation with ASCII ``\\b`` on a shadow text in which non-ASCII
letters are replaced by ``_`` one for one, and reads everything else from the
original text by offset.
"""

from __future__ import annotations

import re

from likeness import lexicon as lx
from likeness import schemas
from likeness.operators import analyses as an
from likeness.operators import heads as hd
from likeness.operators import patterns as pt
from likeness.operators import samples as sm
from registry import corpus
from registry.queries import ENGLISH

SPACE = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]"
)
NON_ASCII_WORD = r"[ªµºÀ-ÖØ-öø-ʯͰ-῿]"
TOKEN = r"[\p{L}\p{N}_''-]+"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _words(words: list[str]) -> str:
    return "(" + ", ".join(_text(word) for word in words) + ")"


def _rows(rows: list[tuple[str, ...]]) -> str:
    return ", ".join("(" + ", ".join(_text(value) for value in row) + ")" for row in rows)


def _shadow_forms(kinds: tuple[str, ...]) -> str:
    return "|".join(re.sub(r"[^\x00-\x7f]", "_", form) for form in lx.ground_forms(kinds))


# ---- bronze ------------------------------------------------------------------------


def _corpus_text() -> str:
    expression = "replace(text, chr(10), ' <END> ')"
    for english, portuguese in corpus.WORDS:
        expression = f"replace({expression}, ' {english} ', ' {portuguese} ')"
    sentences = ", ".join(_text(sentence) for sentence in corpus.SENTENCES)
    count = len(corpus.SENTENCES)
    return f"{expression} || ' <END> ' || ([{sentences}])[doc_id % {count} + 1] || ' <END>  '"


def _lines(kind: str) -> str:
    return {
        "corpus": f"SELECT source AS source_file, doc_id AS original_line_id, "
        f"{_corpus_text()} AS raw_text FROM documents",
        "documents": "SELECT source AS source_file, doc_id AS original_line_id, "
        "text AS raw_text FROM documents",
        "pages": "SELECT url AS source_file, page_id AS original_line_id, "
        "html AS raw_text FROM pages",
        "conversations": "SELECT conv_id || '-' || role AS source_file, "
        "turn AS original_line_id, text AS raw_text FROM conversations",
    }[kind]


def _bronze(kind: str = "corpus") -> str:
    return f"""
lines AS ({_lines(kind)}),
listed AS (
  SELECT source_file, original_line_id,
         list_filter(string_split(raw_text, '<END>'),
                     lambda x: regexp_replace(x, '{SPACE}+', '', 'g') <> '') AS pieces
  FROM lines),
pieces AS (
  SELECT source_file, original_line_id, unnest(pieces) AS piece,
         CAST(generate_subscripts(pieces, 1) - 1 AS INTEGER) AS segment_id
  FROM listed),
bronze AS (
  SELECT source_file, original_line_id, segment_id,
         regexp_replace(piece, '^{SPACE}+|{SPACE}+$', '', 'g') AS text_original,
         trim(regexp_replace(piece, '{SPACE}+', ' ', 'g')) AS text_normalized,
         lower(trim(regexp_replace(piece, '{SPACE}+', ' ', 'g'))) AS match_text
  FROM pieces)"""


# ---- matches -----------------------------------------------------------------------

_ARTICLE = r"(?:um|uma|uns|umas)"
_BOTH = (lx.QUALITY_ADJECTIVE, lx.SALIENT_VERB)
_QUALITY = (lx.QUALITY_ADJECTIVE,)
_PATTERNS = {
    "como_article_ground_vehicle": (
        rf"(?i)\b({_shadow_forms(_BOTH)})\s+(como\s+{_ARTICLE})\b",
        "como",
    ),
    "bare_como_curated_ground": (rf"(?i)\b({_shadow_forms(_QUALITY)})\s+(como)\s+", "como"),
    "bare_como_curated_ground_v2": (rf"(?i)\b({_shadow_forms(_QUALITY)})\s+(como)\s+", "como"),
    "colloquial_que_nem_feito": (
        rf"(?i)\b({_shadow_forms(_BOTH)})\s+(que\s+nem|feito|feita|feitos|feitas)\b",
        "",
    ),
    "broader_ground_window_como_article": (
        r"(?i)\b(?:(?:t_o|tao|mais|menos|muito|bem|quase|bastante)\s+)?"
        rf"({_shadow_forms(_BOTH)})\s+(como\s+{_ARTICLE})\b",
        "como",
    ),
    ENGLISH.pattern_type: (r"(?i)\b(\w+)\s+((?:of|in|by|was)\s+the)\b", "the"),
}


def _pattern_matches(name: str) -> str:
    regex, literal = _PATTERNS[name]
    trailing = name.startswith("bare")
    no_article = (
        rf"WHERE NOT regexp_matches(substr(shadow, match_end + 1), '^(?i){_ARTICLE}\b')"
        if trailing
        else ""
    )
    return rf"""
  SELECT '{name}' AS pattern_type, source_file, original_line_id, segment_id, text_normalized,
         substr(text_normalized, connector_start - ground_gap - ground_length + 1, ground_length)
           AS ground_text,
         CAST(connector_start - ground_gap - ground_length AS INTEGER) AS ground_start,
         substr(text_normalized, connector_start + 1, connector_length) AS connector_text,
         connector_start,
         CAST(connector_start + connector_length AS INTEGER) AS connector_end
  FROM (
    SELECT *, CAST(match_end - {1 if trailing else 0} - connector_length AS INTEGER)
                AS connector_start
    FROM (
      SELECT *, length(regexp_extract(m, '{regex}', 1)) AS ground_length,
             length(regexp_extract(m, '{regex}', 2)) AS connector_length, 1 AS ground_gap,
             CAST(coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)
                  + coalesce(list_sum(list_transform(ms[1:i], lambda x: length(x))), 0)
                  AS INTEGER) AS match_end
      FROM (
        SELECT *, unnest(ms) AS m, generate_subscripts(ms, 1) AS i
        FROM (
          SELECT *, regexp_extract_all(shadow, '{regex}', 0) AS ms,
                 string_split_regex(shadow, '{regex}') AS g
          FROM shadowed WHERE contains(match_text, '{literal}')))))
  {no_article}"""


def _matches(*names: str, kind: str = "corpus", lexicon: str | None = None) -> str:
    union = "\n  UNION ALL".join(_pattern_matches(name) for name in names)
    table = lexicon or (
        "lexicon(form, lemma, ground_type, ground_source, ground_reference_path) AS "
        f"(VALUES {_rows(lx.ground_rows())})"
    )
    return f"""WITH {_bronze(kind)},
shadowed AS (
  SELECT *, regexp_replace(text_normalized, '{NON_ASCII_WORD}', '_', 'g') AS shadow FROM bronze),
{table},
matches AS (
  SELECT h.*, lemma AS ground_lemma, ground_type, ground_source, ground_reference_path,
         CAST(row_number() OVER (
           PARTITION BY pattern_type, source_file, original_line_id, segment_id
           ORDER BY ground_start) - 1 AS INTEGER) AS nth
  FROM ({union}) h JOIN lexicon ON lower(ground_text) = form)"""


_PHRASES = rf"""
phrased AS (
  SELECT *, list_filter(regexp_extract_all(phrase, '{TOKEN}', 0),
                        lambda t: regexp_matches(t, '[\p{{L}}\p{{N}}]')) AS tokens
  FROM (
    SELECT *,
      ltrim(right(rtrim(substr(text_normalized, 1, ground_start)), 80)) AS text_before,
      substr(text_normalized, ground_start + 1, connector_end - ground_start) AS matched_text,
      string_split_regex(ltrim(rest), '[,.!?;:]|(?i:<END>)')[1] AS phrase,
      CAST(connector_end + length(rest) - length(ltrim(rest)) AS INTEGER) AS vehicle_start
    FROM (SELECT *, substr(text_normalized, connector_end + 1) AS rest FROM matches)))"""


def _reach(count: str) -> str:
    token = r"(?:[^\p{L}\p{N}]*[\p{L}\p{N}][\p{L}\p{N}_''-]*)"
    cases = " ".join(
        f"WHEN {n} THEN length(regexp_extract(phrase, '^{token}{{{n}}}', 0))" for n in range(1, 6)
    )
    return f"CASE {count} {cases} ELSE 0 END"


def _join(*parts: str) -> str:
    return "concat_ws(' ', " + ", ".join(f"nullif({part}, '')" for part in parts) + ")"


_ID = (
    "sha1(concat_ws('|', source_file, original_line_id, segment_id, char_start, char_end, "
    "pattern_type))"
)
_ROLE = rf"(?i)\b(?:{'|'.join(lx.ROLE_STEMS)})"

_STRICT = rf"""
strict_pre AS (
  SELECT *, coalesce(tokens[1], '') AS vehicle_head, tokens[1:5] AS used FROM phrased),
strict_reason AS (
  SELECT *,
    CASE WHEN len(tokens) = 0 THEN 'missing_ground_or_vehicle'
         WHEN len(tokens) > 5 THEN 'vehicle_too_long'
         WHEN NOT regexp_matches(vehicle_head, '^\p{{L}}') THEN 'bad_vehicle_start'
         WHEN lower(vehicle_head) IN {_words(lx.STRICT_BAD_STARTS)} THEN 'bad_vehicle_start'
         WHEN lower(vehicle_head) IN {_words(lx.STRICT_GENERIC_HEADS)}
           THEN 'generic_vehicle_head'
         WHEN len(list_filter(tokens, lambda t: regexp_matches(t, '^\p{{Nd}}+$'))) > 0
           THEN 'vehicle_noise'
         WHEN regexp_matches({_join("text_before", "ground_text")}, '{_ROLE}')
           THEN 'role_or_classification_context'
         ELSE '' END AS reject_reason
  FROM strict_pre),
strict_wide AS (
  SELECT *, ground_start AS char_start, connector_text AS connector,
    array_to_string(used, ' ') AS vehicle_text,
    CAST(vehicle_start + {_reach("len(used)")} AS INTEGER) AS char_end,
    list_filter(regexp_extract_all(text_before, '{TOKEN}', 0),
                lambda t: regexp_matches(t, '[\p{{L}}\p{{N}}]')) AS left_tokens
  FROM strict_reason),
labelled AS (
  SELECT {_ID} AS candidate_id, source_file, original_line_id, segment_id, pattern_type,
    connector, connector_text, matched_text,
    {_join("text_before", "matched_text", "vehicle_text")} AS candidate_full_text, text_before,
    array_to_string(left_tokens[-5:], ' ') AS tenor_text,
    lower(array_to_string(left_tokens[-5:], ' ')) AS tenor_lemma,
    CASE WHEN text_before = '' THEN 'missing' ELSE 'fallback_left_context' END
      AS tenor_confidence,
    ground_text, ground_lemma, ground_type, ground_source, vehicle_text,
    lower(vehicle_text) AS vehicle_lemma, vehicle_head,
    lower(vehicle_head) AS vehicle_head_lemma,
    CAST(len(used) AS INTEGER) AS vehicle_phrase_length_tokens,
    CASE WHEN reject_reason = '' THEN 'keep' ELSE 'reject' END AS filter_label, reject_reason,
    CAST(CASE WHEN text_before = '' THEN 0.75 WHEN len(used) = 1 THEN 0.95 ELSE 0.9 END
         AS DOUBLE) AS confidence,
    text_before = '' AS needs_review, char_start, char_end, connector_start, connector_end,
    vehicle_start, char_end AS vehicle_end, ground_reference_path
  FROM strict_wide),
gold AS (SELECT * EXCLUDE (ground_reference_path) FROM labelled WHERE reject_reason = '')"""


def _strict(tail: str, kind: str = "corpus", lexicon: str | None = None, name: str = "") -> str:
    pattern = name or pt.ARTICLE.pattern_type
    return f"{_matches(pattern, kind=kind, lexicon=lexicon)},{_PHRASES},{_STRICT}\n{tail}"


# ---- export ------------------------------------------------------------------------

_CLEAN = rf"""
clean_pre AS (
  SELECT *, list_filter(regexp_extract_all(vehicle_text, '{TOKEN}', 0),
                        lambda t: regexp_matches(t, '[\p{{L}}\p{{N}}]')) AS toks
  FROM gold),
clean_rule AS (
  SELECT *,
    list_position(list_transform(toks[2:], lambda t: lower(t) IN {_words(lx.CLAUSE_STARTS)}),
                  true) AS clause_at
  FROM clean_pre),
clean_cut AS (
  SELECT *,
    CASE WHEN coalesce(clause_at, 0) > 0 THEN 'trimmed_clause_start'
         WHEN len(toks) > 1 AND lower(toks[1]) IN {_words(lx.CLEANUP_HEADS)}
           THEN 'trimmed_common_head_tail'
         ELSE 'unchanged' END AS vehicle_cleaning_rule,
    CASE WHEN coalesce(clause_at, 0) > 0 THEN clause_at
         WHEN len(toks) > 1 AND lower(toks[1]) IN {_words(lx.CLEANUP_HEADS)} THEN 1
         ELSE len(toks) END AS kept
  FROM clean_rule),
clean_label AS (
  SELECT *,
    CASE WHEN reject_reason <> '' THEN 'reject'
         WHEN regexp_matches({_join("text_before", "ground_text", "candidate_full_text")},
                             '{_ROLE}') THEN 'review'
         WHEN vehicle_cleaning_rule <> 'unchanged' THEN 'trimmed'
         ELSE 'keep' END AS quality_label
  FROM clean_cut),
cleaned AS (
  SELECT * EXCLUDE (needs_review), 'v1' AS dataset_version, vehicle_text AS vehicle_text_raw,
    array_to_string(toks[1:kept], ' ') AS vehicle_text_clean,
    array_to_string(toks[kept + 1:], ' ') AS vehicle_tail_text,
    toks[1] AS vehicle_head_clean, lower(toks[1]) AS vehicle_head_clean_lemma,
    concat_ws('|',
      CASE WHEN vehicle_cleaning_rule <> 'unchanged' THEN vehicle_cleaning_rule END,
      CASE WHEN quality_label = 'reject' THEN reject_reason END,
      CASE WHEN quality_label = 'review' THEN 'role_or_classification_context' END)
      AS quality_reason,
    quality_label IN ('keep', 'trimmed') AS visualization_ready,
    needs_review OR quality_label = 'review' AS needs_review
  FROM clean_label)"""

_CORPUS_ORDER = "source_file, original_line_id, segment_id, char_start, char_end, candidate_id"
_EXPORT = ", ".join(schemas.EXPORT_COLUMNS)


def _cleaned(tail: str) -> str:
    return _strict(f",{_CLEAN}\n{tail}")


def _pair_export(first: str, second: str) -> str:
    return _cleaned(
        f"SELECT {first}, {second}, count(*) AS count, "
        f"array_to_string((list(candidate_id ORDER BY {_CORPUS_ORDER}))[1:5], '|') "
        f"AS example_candidate_ids FROM cleaned WHERE {first} <> '' AND {second} <> '' "
        f"GROUP BY ALL"
    )


def _key_export(key: str, related: str, distinct: str, top: str, prefix: str) -> str:
    return _cleaned(
        f""", pairs AS (SELECT {key}, {related}, count(*) AS n FROM cleaned GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, {related}) AS r,
         sum(n) OVER (PARTITION BY {key}) AS total, count(*) OVER (PARTITION BY {key}) AS d
  FROM pairs)
SELECT {key}, CAST(total AS BIGINT) AS count, d AS {distinct}, {related} AS {top},
       n AS {prefix}_count, round(n / total, 4) AS {prefix}_share
FROM ranked WHERE r = 1"""
    )


# ---- pattern variants ----------------------------------------------------------------


def _length_of(tokens: str) -> str:
    stop = _words(lx.STOP_TAIL_TOKENS)

    def ends(index: int) -> str:
        return f"(len({tokens}) < {index} OR lower({tokens}[{index}]) IN {stop})"

    return (
        f"CASE WHEN {ends(2)} THEN 1 WHEN {ends(3)} THEN 2 "
        f"WHEN lower({tokens}[2]) IN {_words(lx.COMPLEMENT_PREPOSITIONS)} AND NOT {ends(4)} "
        f"THEN 4 ELSE 3 END"
    )


_VARIANT = rf"""
v_selected AS (
  SELECT *, tokens[1:({_length_of("tokens")})] AS selected, tokens[2:5] AS shifted,
    pattern_type = 'bare_como_curated_ground_v2' AS v2
  FROM phrased),
v_clean AS (
  SELECT *,
    CASE WHEN v2 AND len(tokens) >= 2 AND lower(tokens[1]) IN {_words(lx.DEFINITE_ARTICLES)}
         THEN shifted[1:({_length_of("shifted")})] ELSE selected END AS clean
  FROM v_selected),
v_head AS (
  SELECT *, lower(coalesce(clean[1], '')) AS vehicle_head_clean,
    v2 AND coalesce(lower(selected[1]) IN {_words(lx.DEFINITE_ARTICLES)}, false) AS led,
    ground_start AS char_start,
    CAST(vehicle_start + {_reach("len(selected)")} AS INTEGER) AS char_end
  FROM v_clean),
v_reason AS (
  SELECT *,
    CASE WHEN len(tokens) = 0 THEN 'missing_vehicle'
         WHEN led AND (len(tokens) < 2
                       OR vehicle_head_clean IN {_words(lx.ARTICLE_REJECT_HEADS)}
                       OR vehicle_head_clean IN {_words(lx.VARIANT_BAD_STARTS)})
           THEN 'bad_definite_article_vehicle'
         WHEN NOT regexp_matches(vehicle_head_clean, '^\p{{L}}')
              OR vehicle_head_clean IN {_words(lx.VARIANT_BAD_STARTS)} THEN 'bad_vehicle_start'
         WHEN vehicle_head_clean IN {_words(lx.VARIANT_GENERIC_HEADS)}
           THEN 'generic_or_role_like_vehicle_head'
         WHEN len(list_filter(selected, lambda t: regexp_matches(t, '^\p{{Nd}}+$'))) > 0
           THEN 'vehicle_noise'
         WHEN len(tokens) > len(selected) THEN 'trimmed_clause_like_tail'
         WHEN len(selected) > 1
              AND len(list_filter(selected, lambda t: regexp_matches(t, '^\p{{Lu}}')))
                  = len(selected) THEN 'capitalized_multi_token_vehicle'
         WHEN led THEN 'stripped_definite_article'
         ELSE 'short_vehicle' END AS quality_reason
  FROM v_head),
v_all AS (
  SELECT *,
    CASE WHEN quality_reason IN ('missing_vehicle', 'bad_definite_article_vehicle',
                                 'bad_vehicle_start', 'vehicle_noise') THEN 'reject'
         WHEN quality_reason IN ('generic_or_role_like_vehicle_head',
                                 'capitalized_multi_token_vehicle') THEN 'review'
         WHEN quality_reason = 'trimmed_clause_like_tail' THEN 'trimmed'
         ELSE 'keep' END AS quality_label
  FROM v_reason),
variants AS (
  SELECT {_ID} AS candidate_id, pattern_type, source_file, original_line_id, segment_id,
    connector_text, matched_text,
    {_join("text_before", "matched_text", "array_to_string(clean, ' ')")}
      AS candidate_full_text, text_before, ground_text, ground_lemma, ground_source,
    array_to_string(tokens, ' ') AS vehicle_text_raw,
    array_to_string(clean, ' ') AS vehicle_text_clean, vehicle_head_clean,
    array_to_string(clean[2:], ' ') AS vehicle_tail_text, quality_label, quality_reason,
    quality_label IN ('reject', 'review') AS needs_review, char_start, char_end
  FROM v_all WHERE len(tokens) > 0)"""

_ACCEPTED = "quality_label IN ('keep', 'trimmed')"


def _variants(tail: str, *names: str) -> str:
    return f"{_matches(*(names or pt.VARIANTS))},{_PHRASES},{_VARIANT}\n{tail}"


def _evaluation(names: list[str], advice: str) -> str:
    table = ", ".join(f"('{name}')" for name in names)
    return _variants(
        rf""", names(pattern_type) AS (VALUES {table}),
sums AS (
  SELECT pattern_type, count(DISTINCT (source_file, original_line_id, segment_id))
           AS prefiltered_rows,
    count(*) FILTER (len(tokens) > 0) AS candidate_rows,
    count(*) FILTER (len(tokens) > 0 AND {_ACCEPTED}) AS accepted_rows,
    count(DISTINCT ground_lemma) FILTER ({_ACCEPTED}) AS distinct_grounds,
    count(DISTINCT vehicle_head_clean) FILTER ({_ACCEPTED}) AS distinct_vehicle_heads,
    count(DISTINCT (ground_lemma, vehicle_head_clean)) FILTER ({_ACCEPTED}) AS distinct_pairs
  FROM v_all GROUP BY 1),
reasons AS (
  SELECT pattern_type, quality_reason,
    row_number() OVER (PARTITION BY pattern_type ORDER BY count(*) DESC, quality_reason) AS r
  FROM variants WHERE NOT {_ACCEPTED} GROUP BY 1, 2),
metrics AS (
  SELECT pattern_type AS experiment_slug, coalesce(prefiltered_rows, 0) AS prefiltered_rows,
    coalesce(candidate_rows, 0) AS candidate_rows, coalesce(accepted_rows, 0) AS accepted_rows,
    coalesce(distinct_grounds, 0) AS distinct_grounds,
    coalesce(distinct_vehicle_heads, 0) AS distinct_vehicle_heads,
    coalesce(distinct_pairs, 0) AS distinct_pairs,
    coalesce(accepted_rows / nullif(candidate_rows, 0), 0) AS accepted_rate,
    coalesce(quality_reason, 'none') AS top_false_positive_reason
  FROM names LEFT JOIN sums USING (pattern_type)
       LEFT JOIN (SELECT * FROM reasons WHERE r = 1) USING (pattern_type))
SELECT *, {advice} AS promotion_recommendation FROM metrics""",
        *names,
    )


_COMPARISON_ADVICE = """CASE
  WHEN experiment_slug = 'broader_ground_window_como_article' AND accepted_rate >= 0.9
    THEN 'promote after baseline overlap check'
  WHEN experiment_slug = 'bare_como_curated_ground' AND accepted_rate >= 0.55
    THEN 'iterate cleanup, then reconsider'
  ELSE 'report-only for visualization build' END"""

_SUMMARY_ADVICE = """CASE WHEN accepted_rate >= 0.6 THEN 'review top pairs before promotion'
  ELSE 'needs another cleanup pass' END"""

_STRATEGY = """CASE
  WHEN experiment_slug = 'broader_ground_window_como_article'
    THEN 'use now: high precision, small enough to review, article-como compatible'
  WHEN experiment_slug = 'bare_como_curated_ground'
    THEN 'do not use for first viz: keep as next expansion after article-head cleanup'
  ELSE 'do not use for first viz: split/redesign connector experiment' END"""

_BASE_PAIRS = (
    "base_pairs AS (SELECT DISTINCT ground_lemma, vehicle_head_lemma AS vehicle_head_clean "
    "FROM gold)"
)


def _strict_and_variants(tail: str, *variants: str) -> str:
    # One match stage for all patterns; the strict part reads the article rows.
    article = pt.ARTICLE.pattern_type
    strict = _STRICT.replace(
        "FROM phrased)", f"FROM phrased WHERE pattern_type = '{article}')", 1
    )
    variant = _VARIANT.replace(
        "FROM phrased)", f"FROM phrased WHERE pattern_type <> '{article}')", 1
    )
    head = _matches(article, *variants)
    return f"{head},{_PHRASES},{strict},{variant}\n{tail}"


# ---- head labels -----------------------------------------------------------------------

_CONTEXT = (
    rf"(?i)\b(?:(?:{'|'.join(hd.ROLE_CONTEXT_WORDS)})\b|(?:{'|'.join(hd.ROLE_CONTEXT_STEMS)}))"
)
_SUFFIX = rf"(?i)(?:{'|'.join(hd.ROLE_SUFFIXES)})$"

_HEADS = f"""
morphology(form, lemma, pos) AS (VALUES {_rows(lx.morphology_rows())}),
tagged AS (
  SELECT v.*, coalesce(lemma, vehicle_head_clean) AS spacy_vehicle_head_lemma,
    coalesce(pos, '') AS spacy_vehicle_head_pos
  FROM variants v LEFT JOIN morphology ON vehicle_head_clean = form),
reasoned AS (
  SELECT *,
    CASE WHEN vehicle_head_clean = '' THEN 'missing_vehicle_head'
         WHEN spacy_vehicle_head_lemma IN {_words(lx.VISUAL_HEADS)}
              OR vehicle_head_clean IN {_words(lx.VISUAL_HEADS)} THEN 'visual_head_whitelist'
         WHEN spacy_vehicle_head_lemma IN {_words(lx.ROLE_HEADS)}
              OR vehicle_head_clean IN {_words(lx.ROLE_HEADS)} THEN 'role_head_lexicon'
         WHEN regexp_matches(candidate_full_text, '{_CONTEXT}') THEN 'role_context'
         WHEN spacy_vehicle_head_pos IN {_words(lx.NON_NOMINAL_POS)}
           THEN 'bad_spacy_pos_' || lower(spacy_vehicle_head_pos)
         WHEN regexp_matches(spacy_vehicle_head_lemma, '{_SUFFIX}')
              AND spacy_vehicle_head_pos IN {_words(lx.NOMINAL_POS)} THEN 'role_like_suffix'
         WHEN len(string_split(vehicle_text_raw, ' ')) > 3 THEN 'long_vehicle_phrase'
         ELSE 'spacy_short_nominal_vehicle' END AS nlp_quality_reason
  FROM tagged),
heads AS (
  SELECT * REPLACE ('bare_como_spacy_filter' AS pattern_type),
    CASE WHEN nlp_quality_reason IN ('visual_head_whitelist', 'spacy_short_nominal_vehicle')
           THEN 'keep'
         WHEN nlp_quality_reason IN ('role_context', 'role_like_suffix', 'long_vehicle_phrase')
           THEN 'review'
         ELSE 'reject' END AS nlp_quality_label,
    nlp_quality_reason NOT IN ('visual_head_whitelist', 'spacy_short_nominal_vehicle')
      AS nlp_needs_review
  FROM reasoned)"""

_V2 = pt.BARE_V2.pattern_type
_HEAD_OK = "nlp_quality_label IN ('keep', 'trimmed')"


def _heads(tail: str) -> str:
    return _variants(f",{_HEADS}\n{tail}", _V2)


def _merged(tail: str) -> str:
    columns = ", ".join(schemas.MERGED_COLUMNS)
    merged = f"""
merged_all AS (
  SELECT {columns} FROM (
    SELECT *, vehicle_text AS vehicle_text_raw, vehicle_text AS vehicle_text_clean,
      vehicle_head_lemma AS vehicle_head_clean, '' AS vehicle_tail_text,
      'keep' AS quality_label, 'spec_0006_strict_filter' AS quality_reason,
      'keep' AS nlp_quality_label, 'spec_0006_baseline' AS nlp_quality_reason,
      vehicle_head_lemma AS spacy_vehicle_head_lemma, '' AS spacy_vehicle_head_pos,
      false AS nlp_needs_review
    FROM gold)
  UNION ALL
  SELECT {columns} FROM (
    SELECT * REPLACE ('bare_como_visual_whitelist' AS pattern_type) FROM heads
    WHERE nlp_quality_reason = 'visual_head_whitelist')),
merged AS (
  SELECT * FROM merged_all
  QUALIFY row_number() OVER (PARTITION BY candidate_id ORDER BY pattern_type) = 1)"""
    return _strict_and_variants(f",{_HEADS},{merged}\n{tail}", _V2)


# ---- analyses -----------------------------------------------------------------------------


def _counts(table: str, *keys: str, where: str = "true") -> str:
    names = ", ".join(keys)
    return f"SELECT {names}, count(*) AS count FROM {table} WHERE {where} GROUP BY {names}"


def _fingerprint(key: str, related: str) -> str:
    return _strict(
        f""", pairs AS (SELECT {key}, {related}, count(*) AS n FROM gold GROUP BY ALL),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY {key} ORDER BY n DESC, {related}) AS INTEGER)
              AS rank,
         sum(n) OVER (PARTITION BY {key}) AS total
  FROM pairs)
SELECT {key}, {related}, rank, n AS count, round(n / total, 4) AS share
FROM ranked WHERE rank <= 10"""
    )


def _tail_has(words: list[str]) -> str:
    return f"len(list_filter(toks[2:], lambda t: lower(t) IN {_words(words)})) > 0"


def _noise() -> str:
    signals = {
        "preposition_after_head": _tail_has(an.PREPOSITIONS),
        "reaches_maximum_length": "len(toks) >= 5",
        "pronoun_after_head": _tail_has(an.PRONOUNS),
        "conjunction_after_head": _tail_has(an.CONJUNCTIONS),
        "generic_or_modifier_head": "lower(vehicle_head) IN "
        + _words(an.MODIFIER_HEADS + lx.STRICT_GENERIC_HEADS),
        "finite_verb_tail": _tail_has(an.FINITE_VERBS),
        "capitalized_multi_token": r"len(toks) > 1 AND "
        r"len(list_filter(toks, lambda t: regexp_matches(t, '^\p{Lu}'))) = len(toks)",
        "contains_digit": r"regexp_matches(vehicle_text, '\p{Nd}')",
    }
    rows = "\nUNION ALL ".join(
        f"SELECT '{name}' AS signal, count(*) FILTER ({rule}) AS count FROM clean_pre"
        for name, rule in signals.items()
    )
    return _cleaned(rows)


_USE_TYPE = rf"""CASE
  WHEN regexp_matches(vehicle_text, '\p{{Nd}}') THEN 'noise'
  WHEN ground_lemma IN {_words(an.IDIOM_GROUNDS)} AND vehicle_head_lemma IN
       {_words(an.IDIOM_HEADS)} THEN 'idiom'
  WHEN ground_lemma = 'trabalhar' OR vehicle_head_lemma IN {_words(lx.ROLE_HEADS)} THEN 'role'
  WHEN regexp_matches(ground_text, '^\p{{Lu}}') AND text_before <> '' THEN 'classification'
  WHEN ground_lemma IN {_words(an.EXTENT_GROUNDS)} AND vehicle_head_lemma IN
       {_words(an.EXTENT_HEADS)} THEN 'literal_extent'
  ELSE 'comparison' END"""

_BENCHMARK = r"""lexicon AS (
  SELECT DISTINCT form, form AS lemma, 'quality_adjective' AS ground_type,
    'benchmark' AS ground_source, 'benchmark' AS ground_reference_path
  FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+', 0)) AS form
        FROM benchmark))"""


def _english(kind: str, tail: str) -> str:
    return _strict(tail, kind=kind, lexicon=_BENCHMARK, name=ENGLISH.pattern_type)


def _prefilter(name: str) -> str:
    return (
        f"{_matches(name)}\nSELECT DISTINCT source_file, original_line_id, segment_id, "
        f"lower(text_normalized) AS match_text FROM matches"
    )


def _select(columns: list[str]) -> str:
    return "SELECT " + ", ".join(columns)


_UNION = (
    "SELECT candidate_id, pattern_type, ground_lemma, vehicle_head_lemma AS vehicle_head_clean "
    "FROM gold UNION ALL SELECT candidate_id, pattern_type, ground_lemma, vehicle_head_clean "
    "FROM variants"
)
_GV = _counts("gold", "ground_lemma", "vehicle_head_lemma")

ORACLE: dict[str, str] = {
    "bronze_segments": f"WITH {_bronze()}\nSELECT * FROM bronze",
    "source_files": f"WITH {_bronze()}\nSELECT DISTINCT source_file FROM bronze",
    "prefilter_article": _prefilter(pt.ARTICLE.pattern_type),
    "prefilter_bare": _prefilter(pt.BARE.pattern_type),
    "prefilter_bare_v2": _prefilter(_V2),
    "prefilter_colloquial": _prefilter(pt.COLLOQUIAL.pattern_type),
    "prefilter_window": _prefilter(pt.WINDOW.pattern_type),
    "match_offsets": _matches(pt.ARTICLE.pattern_type, *pt.VARIANTS)
    + "\nSELECT * EXCLUDE (text_normalized, ground_reference_path) FROM matches",
    "gold_candidates": _strict("SELECT * FROM gold"),
    "labelled_candidates": _strict("SELECT * FROM labelled"),
    "stage_counts": _strict(
        "SELECT count(DISTINCT (source_file, original_line_id, segment_id)) "
        "AS prefiltered_rows, count(*) AS match_rows, "
        "count(*) FILTER (reject_reason = '') AS candidate_rows FROM labelled"
    ),
    "reject_reason_counts": _strict(
        "SELECT reject_reason, count(*) AS count, count(DISTINCT ground_lemma) "
        "AS distinct_ground_count, count(DISTINCT vehicle_head_lemma) "
        "AS distinct_vehicle_count FROM labelled GROUP BY 1"
    ),
    "reject_sample": _strict(
        "SELECT reject_reason, candidate_id, ground_text, vehicle_text, candidate_full_text, "
        "CAST(row_number() OVER (PARTITION BY reject_reason ORDER BY candidate_id) AS INTEGER) "
        "AS rank FROM labelled WHERE reject_reason <> '' QUALIFY rank <= 20"
    ),
    "ground_vehicle_counts": _strict(_GV),
    "vehicle_ground_counts": _strict(_counts("gold", "vehicle_head_lemma", "ground_lemma")),
    "ground_counts": _strict(_counts("gold", "ground_lemma")),
    "vehicle_counts": _strict(_counts("gold", "vehicle_head_lemma")),
    "display_pairs": _strict(
        "SELECT ground_lemma AS ground, vehicle_head_lemma AS vehicle_head, count(*) AS count "
        "FROM gold GROUP BY ALL"
    ),
    "examples": _strict(
        f"{_select(sm.EXAMPLE_COLUMNS)} FROM gold "
        "ORDER BY ground_lemma, vehicle_head_lemma, candidate_id LIMIT 5000"
    ),
    "review_sample": _strict(
        f"{_select(sm.REVIEW_COLUMNS)} FROM gold "
        "ORDER BY needs_review DESC, confidence, candidate_id LIMIT 500"
    ),
    "gold_needing_review": _strict("SELECT * FROM gold WHERE needs_review"),
    "backend_candidates": _cleaned(f"SELECT {_EXPORT} FROM cleaned"),
    "export_ground_vehicle": _pair_export("ground_lemma", "vehicle_head_clean_lemma"),
    "export_vehicle_ground": _pair_export("vehicle_head_clean_lemma", "ground_lemma"),
    "export_ground_counts": _key_export(
        "ground_lemma",
        "vehicle_head_clean_lemma",
        "distinct_vehicle_count",
        "top_vehicle_head_clean_lemma",
        "top_vehicle",
    ),
    "export_vehicle_counts": _key_export(
        "vehicle_head_clean_lemma",
        "ground_lemma",
        "distinct_ground_count",
        "top_ground_lemma",
        "top_ground",
    ),
    "export_examples": _cleaned(
        "SELECT candidate_id, ground_text, connector_text, vehicle_text_clean, tenor_text, "
        f"candidate_full_text FROM cleaned ORDER BY {_CORPUS_ORDER} LIMIT 5000"
    ),
    "export_review": _cleaned(
        f"SELECT {_EXPORT} FROM cleaned WHERE needs_review ORDER BY {_CORPUS_ORDER} LIMIT 500"
    ),
    "export_rejected_or_review": _cleaned(
        f"SELECT {_EXPORT} FROM cleaned WHERE quality_label IN ('reject', 'review')"
    ),
    "manifest": _cleaned(
        "SELECT 'comparisons' AS dataset_name, 'v1' AS dataset_version, "
        "'como_article_ground_vehicle' AS pattern_type, '' AS source_gold_path, "
        "count(*) AS candidate_count, "
        "count(*) FILTER (visualization_ready) AS visualization_ready_count, "
        "count(DISTINCT nullif(ground_lemma, '')) AS ground_count, "
        "count(DISTINCT nullif(vehicle_head_clean_lemma, '')) AS vehicle_count, "
        "count(DISTINCT (ground_lemma, vehicle_head_clean_lemma)) "
        "FILTER (ground_lemma <> '' AND vehicle_head_clean_lemma <> '') "
        "AS ground_vehicle_pair_count, 1 AS schema_version FROM cleaned"
    ),
    "pattern_candidates": _variants("SELECT * FROM variants"),
    "accepted_candidates": _variants(f"SELECT * FROM variants WHERE {_ACCEPTED}"),
    "not_accepted_candidates": _variants(f"SELECT * FROM variants WHERE NOT {_ACCEPTED}"),
    "label_counts": _variants(_counts("variants", "pattern_type", "quality_label")),
    "pattern_pair_counts": _variants(
        _counts(
            "variants", "pattern_type", "ground_lemma", "vehicle_head_clean", where=_ACCEPTED
        )
    ),
    "pattern_vehicle_counts": _variants(
        _counts("variants", "pattern_type", "vehicle_head_clean", where=_ACCEPTED)
    ),
    "reason_counts": _variants(_counts("variants", "quality_reason", where=f"NOT {_ACCEPTED}")),
    "top_reject_reason": _variants(
        "SELECT pattern_type, quality_reason, count(*) AS count FROM variants "
        f"WHERE NOT {_ACCEPTED} GROUP BY pattern_type, quality_reason QUALIFY row_number() OVER "
        "(PARTITION BY pattern_type ORDER BY count(*) DESC, quality_reason) = 1"
    ),
    "pattern_review_sample": _variants(
        f"{_select(sm.VARIANT_REVIEW_COLUMNS)} FROM variants "
        "ORDER BY needs_review DESC, quality_label, candidate_id LIMIT 200"
    ),
    "accepted_review_sample": _variants(
        f"{_select(sm.VARIANT_REVIEW_COLUMNS)} FROM variants WHERE {_ACCEPTED} "
        "ORDER BY quality_label DESC, length(vehicle_text_clean) DESC, ground_lemma, "
        "vehicle_head_clean, candidate_id LIMIT 200"
    ),
    "top_pairs": _variants(
        _counts(
            "variants", "pattern_type", "ground_lemma", "vehicle_head_clean", where=_ACCEPTED
        )
        + " ORDER BY count DESC, pattern_type, ground_lemma, vehicle_head_clean LIMIT 30"
    ),
    "quality_notes": _variants(
        f"SELECT pattern_type, count(*) AS candidate_rows, count(*) FILTER ({_ACCEPTED}) "
        f"AS accepted_rows, count(*) FILTER ({_ACCEPTED}) / count(*) AS accepted_rate, "
        + ", ".join(
            f"count(*) FILTER (quality_label = '{label}') AS {label}_rows"
            for label in ("keep", "trimmed", "review", "reject")
        )
        + " FROM variants GROUP BY 1"
    ),
    "experiment_comparison": _evaluation(list(pt.VARIANTS), _COMPARISON_ADVICE),
    "promotion_summary": _evaluation([_V2], _SUMMARY_ADVICE),
    "pattern_union": _strict_and_variants(_UNION, _V2),
    "pattern_union_counts": _strict_and_variants(
        f"SELECT pattern_type, count(*) AS count FROM ({_UNION}) GROUP BY 1", _V2
    ),
    "new_pairs": _strict_and_variants(
        f", {_BASE_PAIRS}\nSELECT DISTINCT ground_lemma, vehicle_head_clean FROM variants "
        f"WHERE {_ACCEPTED} AND (ground_lemma, vehicle_head_clean) NOT IN "
        "(SELECT (ground_lemma, vehicle_head_clean) FROM base_pairs)",
        _V2,
    ),
    "dataset_strategy": _strict_and_variants(
        f""", {_BASE_PAIRS}, totals AS (
  SELECT pattern_type AS experiment_slug, count(*) FILTER ({_ACCEPTED}) AS accepted_rows,
    count(*) FILTER ({_ACCEPTED}) / count(*) AS accepted_rate FROM variants GROUP BY 1),
overlap AS (
  SELECT pattern_type AS experiment_slug, count(*) AS accepted_distinct_pairs,
    count(b.ground_lemma) AS baseline_overlapping_pairs,
    count(*) - count(b.ground_lemma) AS new_pairs_vs_baseline
  FROM (SELECT DISTINCT pattern_type, ground_lemma, vehicle_head_clean FROM variants
        WHERE {_ACCEPTED}) v
  LEFT JOIN base_pairs b USING (ground_lemma, vehicle_head_clean) GROUP BY 1)
SELECT *, {_STRATEGY} AS dataset_strategy FROM totals JOIN overlap USING (experiment_slug)""",
        *pt.VARIANTS,
    ),
    "nlp_labels": _heads("SELECT * FROM heads"),
    "tagged_head_counts": _variants(
        """
SELECT translate(vehicle_head_clean, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    AS head_lemma,
  CASE WHEN vehicle_head_clean IS NULL THEN 'X'
       WHEN regexp_matches(vehicle_head_clean, '^[A-Z]') THEN 'PROPN' ELSE 'NOUN' END AS head_pos,
  count(*) AS n
FROM variants GROUP BY 1, 2""",
        _V2,
    ),
    "nlp_accepted": _heads(f"SELECT * FROM heads WHERE {_HEAD_OK}"),
    "nlp_promoted": _heads(
        "SELECT * REPLACE ('bare_como_visual_whitelist' AS pattern_type) FROM heads "
        "WHERE nlp_quality_reason = 'visual_head_whitelist'"
    ),
    "nlp_label_counts": _heads(
        _counts(
            "heads", "pattern_type", "quality_label", "nlp_quality_label", "nlp_quality_reason"
        )
    ),
    "nlp_reason_counts": _heads(
        _counts("heads", "quality_label", "nlp_quality_label", "nlp_quality_reason")
    ),
    "nlp_pair_counts": _heads(
        _counts("heads", "pattern_type", "ground_lemma", "vehicle_head_clean", where=_HEAD_OK)
    ),
    "nlp_vehicle_counts": _heads(
        _counts(
            "heads",
            "pattern_type",
            "vehicle_head_clean",
            "spacy_vehicle_head_lemma",
            "spacy_vehicle_head_pos",
            where=_HEAD_OK,
        )
    ),
    "nlp_accepted_sample": _heads(
        f"{_select(sm.HEAD_REVIEW_COLUMNS)} FROM heads WHERE {_HEAD_OK} ORDER BY "
        "nlp_quality_reason, ground_lemma, vehicle_head_clean, candidate_id LIMIT 500"
    ),
    "nlp_review_sample": _heads(
        f"{_select(sm.HEAD_REVIEW_COLUMNS)} FROM heads ORDER BY nlp_needs_review DESC, "
        "nlp_quality_label, nlp_quality_reason, candidate_id LIMIT 500"
    ),
    "merged_dataset": _merged("SELECT * FROM merged"),
    "merged_pattern_counts": _merged(_counts("merged", "pattern_type")),
    "merged_pair_counts": _merged(_counts("merged", "ground_lemma", "vehicle_head_clean")),
    "merged_reverse_pair_counts": _merged(
        _counts("merged", "vehicle_head_clean", "ground_lemma")
    ),
    "merged_ground_counts": _merged(_counts("merged", "ground_lemma")),
    "merged_vehicle_counts": _merged(_counts("merged", "vehicle_head_clean")),
    "merged_examples": _merged(
        f"{_select(sm.MERGED_EXAMPLE_COLUMNS)} FROM merged ORDER BY ground_lemma, "
        "vehicle_head_clean, pattern_type, candidate_id LIMIT 5000"
    ),
    "merged_review_sample": _merged(
        f"{_select(sm.HEAD_REVIEW_COLUMNS)} FROM merged ORDER BY pattern_type, ground_lemma, "
        "vehicle_head_clean, candidate_id LIMIT 1000"
    ),
    "dominance": _strict(
        """, pairs AS (
  SELECT ground_lemma, vehicle_head_lemma, count(*) AS n FROM gold GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY ground_lemma ORDER BY n DESC, vehicle_head_lemma)
              AS r,
         sum(n) OVER (PARTITION BY ground_lemma) AS total,
         count(*) OVER (PARTITION BY ground_lemma) AS d
  FROM pairs)
SELECT ground_lemma, vehicle_head_lemma AS top_vehicle_head_lemma, n AS top_vehicle_count,
       CAST(total AS BIGINT) AS total_count, round(n / total, 4) AS top_vehicle_share,
       d AS distinct_vehicle_count
FROM ranked WHERE r = 1"""
    ),
    "ground_fingerprint": _fingerprint("ground_lemma", "vehicle_head_lemma"),
    "vehicle_fingerprint": _fingerprint("vehicle_head_lemma", "ground_lemma"),
    "simpson_index": _strict(
        """, pairs AS (
  SELECT vehicle_head_lemma, ground_lemma, count(*) AS n FROM gold GROUP BY ALL)
SELECT vehicle_head_lemma, CAST(sum(n) AS BIGINT) AS total_count, count(*) AS distinct_count,
       round(1 - sum(n * n) / (sum(n) * sum(n)), 4) AS diversity
FROM pairs GROUP BY 1"""
    ),
    "length_distribution": _strict(_counts("gold", "vehicle_phrase_length_tokens")),
    "noise_profile": _noise(),
    "use_type_counts": _strict(
        f"SELECT {_USE_TYPE} AS comparison_use_type, count(*) AS count FROM gold GROUP BY 1"
    ),
    "lexicon_source_counts": _strict(
        _counts("labelled", "ground_source", "ground_reference_path", "ground_lemma")
    ),
    "lexicon_join_counts": _matches(
        ENGLISH.pattern_type, kind="documents", lexicon=_BENCHMARK
    )
    + "\n"
    + _counts("matches", "ground_source", "ground_lemma"),
    "english_the_counts": _english("documents", _GV),
    "english_page_counts": _english("pages", _GV),
    "english_conversation_counts": _english("conversations", _GV),
}

# ---- lexicons of any form, and lexicon files ---------------------------------------

_BEFORE = r"[\p{L}\p{N}_]+[^\p{L}\p{N}_]+[\p{L}\p{N}_]+$"
_PHRASE_LEXICON = r"""lexicon AS (
  SELECT DISTINCT form, form AS lemma, 'benchmark' AS ground_source
  FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+', 0)) AS form FROM benchmark)
  UNION ALL
  SELECT DISTINCT form, form, 'phrase'
  FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+ [\p{L}\p{N}_]+', 0)) AS form
        FROM benchmark))"""
ORACLE["lexicon_phrase_counts"] = rf"""WITH {_bronze("documents")},
shadowed AS (
  SELECT *, regexp_replace(text_normalized, '{NON_ASCII_WORD}', '_', 'g') AS shadow FROM bronze),
{_PHRASE_LEXICON},
hits AS (
  SELECT *, ground_start + length(ground_text) AS ground_end,
    coalesce(lag(connector_end) OVER (
      PARTITION BY source_file, original_line_id, segment_id ORDER BY connector_start), 0) AS free
  FROM ({_pattern_matches(ENGLISH.pattern_type)})),
candidates AS (
  SELECT *, ground_text AS candidate FROM hits
  UNION ALL
  SELECT * FROM (
    SELECT *, regexp_extract(substr(text_normalized, 1, ground_end), '{_BEFORE}') AS candidate
    FROM hits)
  WHERE candidate <> '' AND ground_end - length(candidate) >= free),
matches AS (
  SELECT ground_source, lemma AS ground_lemma
  FROM candidates JOIN lexicon ON lower(candidate) = form
  QUALIFY row_number() OVER (
    PARTITION BY source_file, original_line_id, segment_id, connector_start
    ORDER BY length(candidate) DESC) = 1)
{_counts("matches", "ground_source", "ground_lemma")}"""
_PHRASE_MATCHES = ORACLE["lexicon_phrase_counts"].split("matches AS (")[0]
ORACLE["prefilter_with_lexicon"] = _PHRASE_MATCHES + """matches AS (
  SELECT source_file, original_line_id, segment_id
  FROM candidates JOIN lexicon ON lower(candidate) = form
  QUALIFY row_number() OVER (
    PARTITION BY source_file, original_line_id, segment_id, connector_start
    ORDER BY length(candidate) DESC) = 1)
SELECT source_file, original_line_id, segment_id, count(*) AS n_matches
FROM matches GROUP BY source_file, original_line_id, segment_id"""
ORACLE["quality_words"] = """
SELECT lower(trim(value)) AS form, lower(trim(value)) AS lemma, 'quality_adjective' AS ground_type,
  'quality_reference' AS ground_source, source AS ground_reference_path
FROM (SELECT source, unnest(string_split(text, chr(10))) AS value FROM documents)
WHERE trim(value) <> ''"""
ORACLE["verb_groups"] = r"""WITH files AS (
  SELECT source || '-' || doc_id AS path,
    trim(replace(replace(text, '.', chr(10) || chr(10)), ' ', chr(10))) AS value FROM documents),
blocks AS (
  SELECT path, string_split_regex(value, '\r?\n[ \t]*(?:\r?\n[ \t]*)+') AS blocks FROM files),
groups AS (
  SELECT path, unnest(blocks) AS block, generate_subscripts(blocks, 1) AS group_id FROM blocks),
words AS (
  SELECT path, group_id, list_filter(list_transform(string_split_regex(block, '\r?\n'),
    lambda w: lower(trim(w))), lambda w: w <> '') AS words FROM groups),
forms AS (SELECT path, group_id, words[1] AS lemma, unnest(words) AS form FROM words)
SELECT form, lemma, 'salient_verb' AS ground_type, 'verb_reference' AS ground_source,
  path AS ground_reference_path
FROM forms
QUALIFY row_number() OVER (PARTITION BY form ORDER BY path, group_id, lemma) = 1"""


# ---- unmodified documents: the same tails on English matches ------------------------

_ENGLISH_MATCHES = _matches(ENGLISH.pattern_type, kind="documents", lexicon=_BENCHMARK)


def _on_documents(sql: str) -> str:
    """A query's SQL with the matches of the re-worded corpus replaced by English ones."""
    for names in ((pt.ARTICLE.pattern_type,), tuple(pt.VARIANTS), (_V2,)):
        corpus_matches = _matches(*names)
        if sql.startswith(corpus_matches + ","):
            return _ENGLISH_MATCHES + sql.removeprefix(corpus_matches)
    raise ValueError("Not a query on the matches of one pattern family")


for _name in """
gold_candidates labelled_candidates reject_reason_counts ground_counts vehicle_counts examples
review_sample backend_candidates export_ground_vehicle export_ground_counts manifest dominance
ground_fingerprint simpson_index length_distribution noise_profile use_type_counts
pattern_candidates label_counts pattern_pair_counts reason_counts nlp_labels nlp_label_counts
""".split():
    ORACLE[f"english_{_name}"] = _on_documents(ORACLE[_name])
ORACLE["stage_counts_with_lexicon"] = _on_documents(ORACLE["stage_counts"])

# Written and read back: the same rows as the tables themselves.
ORACLE["csv_read_back"] = ORACLE["ground_vehicle_counts"]
ORACLE["json_read_back"] = ORACLE["backend_candidates"]
