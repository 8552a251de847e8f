"""Gold candidates and labelled pattern variants.

Both start from :func:`find_matches`, add the left context and the vehicle
phrase as columns, and decide on labels with one ``when`` chain each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likeness import lexicon as lx
from likeness import schemas
from likeness.functions import text as tx
from likeness.operators import patterns as pt

# ---- fixed values -----------------------------------------------------------
LEFT_CONTEXT_CHARS = 80
STRICT_MAX_TOKENS = 5
VARIANT_MAX_TOKENS = 4
TENOR_TOKENS = 5
ALL_DIGITS = r"(?U)^\d+$"
STARTS_WITH_LETTER = r"^\p{L}"
STARTS_UPPER = r"^\p{Lu}"


def match_phrases(
    segments: DataFrame, specs: list[pt.PatternSpec], lexicon: DataFrame | None = None
) -> DataFrame:
    """Matches with left context, vehicle phrase and its tokens.

    This is the only step that reads the corpus.  Its result is small, holds
    everything the labels need and may be stored for several consumers.  The
    segment text is dropped before the lexicon join, so a large lexicon that
    has to be shuffled meets short rows only.
    """
    hits = pt.find_hits(segments, specs, None if lexicon is None else pt.reach_of(lexicon))
    return pt.with_lexicon(_phrases(hits), specs, lexicon)


def _phrases(hits: DataFrame) -> DataFrame:
    text = F.col("text_normalized")
    left = F.rtrim(tx.head_to(text, F.col("ground_start")))
    return (
        hits.withColumn("right_text", tx.tail_from(text, F.col("connector_end")))
        .withColumn("text_before", F.ltrim(F.right(left, F.lit(LEFT_CONTEXT_CHARS))))
        .withColumn(
            "matched_text",
            F.substring(
                text,
                F.col("ground_start") + F.lit(1),
                F.col("connector_end") - F.col("ground_start"),
            ),
        )
        .withColumn("phrase", tx.until_boundary(F.ltrim("right_text")))
        .withColumn(
            "vehicle_start",
            F.col("connector_end") + F.length("right_text") - F.length(F.ltrim("right_text")),
        )
        .withColumn("tokens", tx.word_tokens(F.col("phrase")))
        .drop("right_text", "text_normalized")
    )


def _candidate_id() -> Column:
    identity = F.concat_ws("|", *[F.col(name) for name in [*schemas.PROVENANCE, "pattern_type"]])
    return F.sha1(identity)


# ---- strict article pattern --------------------------------------------------


def _strict_reject_reason() -> Column:
    head = F.lower("vehicle_head")
    role = tx.join_nonempty(F.col("text_before"), F.col("ground_text"))
    return (
        F.when(F.size("tokens") == 0, "missing_ground_or_vehicle")
        .when(F.size("tokens") > STRICT_MAX_TOKENS, "vehicle_too_long")
        .when(~head.rlike(STARTS_WITH_LETTER), "bad_vehicle_start")
        .when(tx.one_of(head, lx.STRICT_BAD_STARTS), "bad_vehicle_start")
        .when(tx.one_of(head, lx.STRICT_GENERIC_HEADS), "generic_vehicle_head")
        .when(F.exists("tokens", lambda t: t.rlike(ALL_DIGITS)), "vehicle_noise")
        .when(role.rlike(tx.stem_after_boundary(lx.ROLE_STEMS)), "role_or_classification_context")
        .otherwise("")
    )


def strict_matches(
    segments: DataFrame, lexicon: DataFrame | None = None, spec: pt.PatternSpec = pt.ARTICLE
) -> DataFrame:
    """Matches of a strict pattern with a reject reason; '' means kept."""
    return label_strict(match_phrases(segments, [spec], lexicon))


def label_strict(phrases: DataFrame) -> DataFrame:
    """Vehicle head and reject reason of matched phrases."""
    headed = phrases.withColumn("vehicle_head", tx.first_or_empty(F.col("tokens")))
    return tx.computed_once(headed, reject_reason=_strict_reject_reason())


def labelled_candidates(
    segments: DataFrame, lexicon: DataFrame | None = None, spec: pt.PatternSpec = pt.ARTICLE
) -> DataFrame:
    """All candidates of a strict pattern, kept and rejected, in the gold layout.

    ``filter_label`` is ``keep`` or ``reject``; ``ground_reference_path`` tells
    which lexicon source the ground came from.
    """
    return _gold_columns(strict_matches(segments, lexicon, spec), "ground_reference_path")


def gold_candidates(
    segments: DataFrame, lexicon: DataFrame | None = None, spec: pt.PatternSpec = pt.ARTICLE
) -> DataFrame:
    """Kept candidates of a strict pattern (the gold table, 32 columns)."""
    return gold_from_matches(strict_matches(segments, lexicon, spec))


def gold_from_matches(matches: DataFrame) -> DataFrame:
    """Gold columns of the labelled matches without a reject reason."""
    return _gold_columns(matches.where(F.col("reject_reason") == ""))


def of_patterns(phrases: DataFrame, *pattern_types: str) -> DataFrame:
    """The rows of some patterns out of a shared match table."""
    return phrases.where(F.col("pattern_type").isin(list(pattern_types)))


def _gold_columns(matches: DataFrame, *extra: str) -> DataFrame:
    used = F.slice("tokens", 1, STRICT_MAX_TOKENS)
    count = F.size("vehicle_tokens")
    tenor = tx.joined(tx.last_tokens(tx.word_tokens(F.col("text_before")), TENOR_TOKENS))
    no_context = F.col("text_before") == ""
    return (
        matches.withColumn("vehicle_tokens", used)
        .withColumn("vehicle_text", tx.joined(F.col("vehicle_tokens")))
        .withColumn("tenor_text", tenor)
        .withColumn(
            "vehicle_end",
            F.col("vehicle_start") + tx.end_of_token(F.col("phrase"), count, STRICT_MAX_TOKENS),
        )
        .withColumns(
            {
                "char_start": F.col("ground_start"),
                "char_end": F.col("vehicle_end"),
                "connector": F.col("connector_text"),
                "candidate_full_text": tx.join_nonempty(
                    F.col("text_before"), F.col("matched_text"), F.col("vehicle_text")
                ),
                "tenor_lemma": F.lower("tenor_text"),
                "tenor_confidence": F.when(no_context, "missing").otherwise(
                    "fallback_left_context"
                ),
                "vehicle_lemma": F.lower("vehicle_text"),
                "vehicle_head_lemma": F.lower("vehicle_head"),
                "vehicle_phrase_length_tokens": count,
                "filter_label": F.when(F.col("reject_reason") == "", "keep").otherwise("reject"),
                "confidence": F.when(no_context, 0.75).when(count == 1, 0.95).otherwise(0.9),
                "needs_review": no_context,
            }
        )
        .withColumn("candidate_id", _candidate_id())
        .select(*schemas.columns(schemas.GOLD), *extra)
    )


# ---- labelled pattern variants -------------------------------------------------


def _selected_length(tokens: Column) -> Column:
    """How many leading tokens form the vehicle: 1 to 4.

    The second and third token must not be stop words; a fourth is taken only
    after a complement preposition in second place ("pedra de amolar faca").
    """

    def may_follow(index: int) -> Column:
        token = F.lower(F.get(tokens, F.lit(index)))
        return token.isNotNull() & ~tx.one_of(token, lx.STOP_TAIL_TOKENS)

    second = F.lower(F.get(tokens, F.lit(1)))
    return (
        F.when(~may_follow(1), 1)
        .when(~may_follow(2), 2)
        .when(tx.one_of(second, lx.COMPLEMENT_PREPOSITIONS) & may_follow(3), 4)
        .otherwise(3)
    )


def _selected(tokens: Column) -> Column:
    return F.slice(tokens, F.lit(1), _selected_length(tokens))


def _variant_decision() -> Column:
    """Label, reason and review flag; the first rule that holds wins."""
    raw, selected = F.col("tokens"), F.col("selected")
    head = F.col("vehicle_head_clean")
    led_by_article = F.col("strip_article") & tx.one_of(
        F.lower(F.get(selected, F.lit(0))), lx.DEFINITE_ARTICLES
    )
    listed = tx.one_of(head, lx.VARIANT_BAD_STARTS)
    bad_after_article = (F.size(raw) < 2) | tx.one_of(head, lx.ARTICLE_REJECT_HEADS) | listed
    bad_start = ~head.rlike(STARTS_WITH_LETTER) | listed
    capitalised = (F.size(selected) > 1) & F.forall(selected, lambda t: t.rlike(STARTS_UPPER))

    def decided(label: str, reason: str, review: bool) -> Column:
        return F.struct(
            F.lit(label).alias("quality_label"),
            F.lit(reason).alias("quality_reason"),
            F.lit(review).alias("needs_review"),
        )

    return (
        F.when(F.size(raw) == 0, decided("reject", "missing_vehicle", True))
        .when(
            led_by_article & bad_after_article,
            decided("reject", "bad_definite_article_vehicle", True),
        )
        .when(bad_start, decided("reject", "bad_vehicle_start", True))
        .when(
            tx.one_of(head, lx.VARIANT_GENERIC_HEADS),
            decided("review", "generic_or_role_like_vehicle_head", True),
        )
        .when(
            F.exists(selected, lambda t: t.rlike(ALL_DIGITS)),
            decided("reject", "vehicle_noise", True),
        )
        .when(
            F.size(raw) > F.size(selected),
            decided("trimmed", "trimmed_clause_like_tail", False),
        )
        .when(capitalised, decided("review", "capitalized_multi_token_vehicle", True))
        .when(led_by_article, decided("keep", "stripped_definite_article", False))
        .otherwise(decided("keep", "short_vehicle", False))
    )


def variant_matches(
    segments: DataFrame, pattern_types: list[str], lexicon: DataFrame | None = None
) -> DataFrame:
    """Labelled matches of the pattern variants, also those without a vehicle.

    ``nth`` is 0 on the first match of a pattern in a segment, so counting
    those rows counts the segments that hold the pattern.
    """
    specs = [pt.variant(name) for name in pattern_types]
    return label_variants(match_phrases(segments, specs, lexicon))


def label_variants(phrases: DataFrame) -> DataFrame:
    """Vehicle selection, article stripping and quality decision."""
    stripping = [spec.pattern_type for spec in pt.VARIANTS.values() if spec.strip_article]
    tokens = F.col("tokens")
    has_article = (
        F.col("strip_article")
        & (F.size(tokens) >= 2)
        & tx.one_of(F.lower(F.get(tokens, F.lit(0))), lx.DEFINITE_ARTICLES)
    )
    after_article = F.slice(tokens, F.lit(2), F.lit(VARIANT_MAX_TOKENS))
    chosen = (
        phrases.withColumn("strip_article", F.col("pattern_type").isin(stripping))
        .withColumn("selected", _selected(tokens))
        .withColumn(
            "clean", F.when(has_article, _selected(after_article)).otherwise(F.col("selected"))
        )
    )
    headed = tx.computed_once(
        chosen, vehicle_head_clean=F.lower(tx.first_or_empty(F.col("clean")))
    )
    return headed.select("*", F.inline(F.array(_variant_decision())))


def variant_columns(matches: DataFrame) -> DataFrame:
    """The 21-column candidate table; matches without a vehicle drop out."""
    with_vehicle = matches.where(F.size("tokens") > 0)
    reach = tx.end_of_token(F.col("phrase"), F.size("selected"), VARIANT_MAX_TOKENS)
    return (
        with_vehicle.withColumns(
            {
                "vehicle_text_raw": tx.joined(F.col("tokens")),
                "vehicle_text_clean": tx.joined(F.col("clean")),
                "vehicle_tail_text": tx.joined(tx.drop_first(F.col("clean"))),
                "char_start": F.col("ground_start"),
                "char_end": F.col("vehicle_start") + reach,
            }
        )
        .withColumn(
            "candidate_full_text",
            tx.join_nonempty(
                F.col("text_before"), F.col("matched_text"), F.col("vehicle_text_clean")
            ),
        )
        .withColumn("candidate_id", _candidate_id())
        .select(*schemas.columns(schemas.VARIANT))
    )


def variant_candidates(
    segments: DataFrame,
    pattern_types: list[str] | None = None,
    lexicon: DataFrame | None = None,
) -> DataFrame:
    """Candidates of one or more pattern variants, all from one scan."""
    names = list(pt.VARIANTS) if pattern_types is None else pattern_types
    return variant_columns(variant_matches(segments, names, lexicon))


def accepted(candidates: DataFrame) -> DataFrame:
    """Candidates labelled keep or trimmed."""
    return candidates.where(F.col("quality_label").isin("keep", "trimmed"))


def not_accepted(candidates: DataFrame) -> DataFrame:
    """Candidates labelled review or reject."""
    return candidates.where(F.col("quality_label").isin("review", "reject"))
