"""Extraction tables: transcripts, extractor requests, parsed responses.

Remote calls (captions, the extractor model) are outside Spark; these operators
prepare what is sent and turn what was landed into prediction rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import dims
from ..functions.dates import lenient_date
from ..functions.scoring import classify_match_type
from ..functions.text import strip_fence, strip_ws

# Strict JSON-array shape: the whole text must be one bracketed value.
_ARRAY_TEXT = r"(?s)^[ \t\n\r]*\[.*\][ \t\n\r]*$"


def assemble_transcripts(segments: DataFrame, languages=("es", "en"), key="video_id",
                         lang="lang", order="seq", text="text", chunk: int = 1024) -> DataFrame:
    """One transcript per video: the most preferred language present, segments
    joined by a space in order.  Videos with no preferred language are dropped.

    Two aggregations on ``key`` share one hash partitioning: the preferred
    language is picked first, so only its segments are concatenated.
    """
    rank = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col(lang))
    ranked = segments.where(F.col(lang).isin(*languages)).withColumn("_rank", rank)
    best = ranked.groupBy(key).agg(F.min("_rank").alias("_rank"))
    chosen = ranked.join(best, [key, "_rank"], "left_semi")
    # two levels, so one very long video is not concatenated by a single task:
    # consecutive runs of ``chunk`` positions are joined in parallel, then the
    # runs are joined in order (same text: both levels use one space)
    runs = (chosen.withColumn("_run", F.floor(F.col(order) / F.lit(chunk)))
            .groupBy(key, "_run")
            .agg(F.min(lang).alias(lang),
                 F.expr(f"string_agg({text}, ' ') within group (order by {order})").alias("_part")))
    return (runs.groupBy(key)
            .agg(F.min(lang).alias(lang),
                 F.expr("string_agg(_part, ' ') within group (order by _run)").alias("transcript")))


def extraction_requests(transcripts: DataFrame, text="transcript",
                        cap: int = dims.TRANSCRIPT_CHAR_CAP) -> DataFrame:
    """The user messages sent to the extractor: fixed prefix + ``cap`` characters of the text.

    A longer text is sent whole, in ``n_requests`` messages in order of
    ``request_no`` (from 1), and is marked ``truncated`` in each; a null text has
    one null message, an empty one the prefix alone.
    """
    chars = F.coalesce(F.char_length(F.col(text)), F.lit(0))
    n = F.greatest(F.ceil(chars / F.lit(cap)).cast("int"), F.lit(1))
    pieces = transcripts.select("*", n.alias("n_requests")).select(
        "*", F.explode(F.sequence(F.lit(1), F.col("n_requests"))).alias("request_no"))
    body = F.substring(F.col(text), (F.col("request_no") - 1) * F.lit(cap) + 1, F.lit(cap))
    return pieces.select(
        "*",
        F.concat(F.lit(dims.EXTRACTION_PREFIX), body).alias("request"),
        (F.char_length(F.col(text)) > cap).alias("truncated"))


def parse_responses(responses: DataFrame, raw="raw_response") -> DataFrame:
    """Adds ``parsed`` (VARIANT array or null), ``parse_ok`` and ``parse_error`` (null, ``empty``, ``json`` or ``not_array``).

    The text behind the fence must be exactly one JSON array. The parser stops at the end of the
    first value, so the text is parsed inside two frames: in ``[text,"#end"]`` the mark must be the second and
    last element, in ``{"v":text,"e":0}`` the key ``e`` must still be there. Text around or between values, or
    brackets that close a frame early, spoil one of them. A key that repeats within an object is an error.
    """
    # one projection per stage: each stage's output is referenced more than once by
    # the next, so Catalyst keeps the stages apart instead of inlining (and
    # re-evaluating) the regex and JSON work in every reference
    body, listed, keyed = F.col("_body"), F.col("_listed"), F.col("_keyed")
    framed = (responses.withColumn("_body", strip_fence(F.col(raw)))
              .withColumn("_listed", F.when(body.rlike(_ARRAY_TEXT), F.try_parse_json(F.concat(F.lit("["), body, F.lit(',"#end"]')))))
              .withColumn("_keyed", F.try_parse_json(F.concat(F.lit('{"v":'), body, F.lit(',"e":0}')))))
    one_value = F.coalesce(F.try_variant_get(keyed, "$.e", "int") == 0, F.lit(False))
    one_array = (F.coalesce(F.try_variant_get(listed, "$[1]", "string") == "#end", F.lit(False))
                 & F.try_variant_get(listed, "$[2]", "variant").isNull())
    error = (F.when(F.coalesce(body, F.lit("")) == "", "empty").when(~one_value, "json")
             .when(~body.rlike(_ARRAY_TEXT), "not_array").when(~one_array, "json"))
    return (framed.withColumn("parse_error", error)
            .withColumn("parsed", F.when(F.col("parse_error").isNull(), F.try_variant_get(listed, "$[0]", "variant")))
            .withColumn("parse_ok", F.col("parse_error").isNull())
            .drop("_body", "_listed", "_keyed"))


def _field(v, key: str, typ: str):
    return F.try_variant_get(v, f"$.{key}", typ)


def _absent(v, key: str):
    return F.variant_get(v, f"$.{key}", "variant").isNull()


def extraction_batch(parsed: DataFrame, id_col="video_id", extracted_at: str | None = None) -> DataFrame:
    """What a batch of responses comes to: a row per array element, and one per response that is no array.

    ``reject`` routes the rows: false for predictions; true, with a ``reject_reason``, for what the table must
    not hold: ``empty``, ``json``, ``not_array`` (the response; ``pos`` is null), ``element`` (not an object),
    ``percentage`` (null, or no whole number). Element rows are those of ``build_prediction_rows``.
    """
    # failed responses come out of the explode with a null position, empty arrays are left out
    exploded = parsed.select(
        "*", F.posexplode_outer(F.variant_get(F.col("parsed"), "$", "array<variant>")).alias("pos", "elem"))
    exploded = exploded.where(F.col("pos").isNotNull() | F.col("parse_error").isNotNull())
    e = F.col("elem")
    is_obj = F.coalesce(F.schema_of_variant(e).startswith("OBJECT<"), F.lit(False))

    def pct(k):
        # a quoted number must be whole (the original's int() of a text); a number is truncated
        quoted = F.schema_of_variant(F.variant_get(e, f"$.{k}", "variant")) == "STRING"
        text = strip_ws(_field(e, k, "string"))
        whole = F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))
        return F.when(_absent(e, k), F.lit(0)).when(quoted, whole).otherwise(_field(e, k, "int"))

    def text(k, default):
        return F.when(_absent(e, k), F.lit(default)).otherwise(_field(e, k, "string"))

    md = _field(e, "match_date", "string")
    has = lambda c, kind: F.col(c) if c in parsed.columns else F.lit(None).cast(kind)
    rows = exploded.select(
        F.when(F.col("pos").isNotNull(), F.format_string("%s_%03d", F.col(id_col), F.col("pos"))).alias("prediction_id"),
        F.col(id_col).alias("video_id"),
        has("video_url", "string").alias("video_url"),
        *[c for c in ["publish_date"] if c in parsed.columns],
        F.nullif(md, F.lit("")).alias("match_date_text"),
        text("home_team", "").alias("home_team"),
        text("away_team", "").alias("away_team"),
        text("competition", "Unknown").alias("competition"),
        pct("pred_home_win_pct").alias("pred_home_win_pct"),
        pct("pred_draw_pct").alias("pred_draw_pct"),
        pct("pred_away_win_pct").alias("pred_away_win_pct"),
        text("raw_quote", "").alias("raw_quote"),
        F.lit(extracted_at).cast("date").alias("extracted_at"),
        "pos", "parse_error", is_obj.alias("_is_obj"), F.to_json(e).alias("element"),
    )
    pred_sum = F.col("pred_home_win_pct") + F.col("pred_draw_pct") + F.col("pred_away_win_pct")
    reason = (F.when(F.col("parse_error").isNotNull(), F.col("parse_error")).when(~F.col("_is_obj"), "element")
              .when(pred_sum.isNull(), "percentage"))
    return (rows
            .withColumn("match_date", lenient_date(F.col("match_date_text")))
            .withColumn("match_type", classify_match_type(F.col("pred_draw_pct")))
            .withColumn("leg_number", F.lit(None).cast("int"))
            .withColumn("pred_sum", pred_sum)
            .withColumn("pred_sum_ok", pred_sum == 100)
            .withColumn("reject_reason", reason)
            .withColumn("reject", F.col("reject_reason").isNotNull())
            .drop("parse_error", "_is_obj"))


def build_prediction_rows(parsed: DataFrame, id_col="video_id", extracted_at: str | None = None) -> DataFrame:
    """One row per array element (index over all elements), with key defaults.

    Absent pct keys default to 0; absent competition to 'Unknown'; absent team /
    quote keys to '' (a JSON null stays null); '' match_date becomes null.
    Percentages truncate to int (45.9 -> 45) and accept quoted whole numbers.  An
    element that is not an object, or has a null or unusable percentage, is kept with ``reject = true``.
    """
    return extraction_batch(parsed, id_col, extracted_at).where(F.col("pos").isNotNull()).drop("pos", "element")


def accepted(batch: DataFrame) -> DataFrame:
    """The predictions of a routed batch."""
    return batch.where(~F.col("reject")).drop("reject", "reject_reason", "pos", "element")


def rejected(batch: DataFrame) -> DataFrame:
    """What a routed batch keeps from the table, and why."""
    return batch.where("reject").select("video_id", "pos", "reject_reason", "element")
