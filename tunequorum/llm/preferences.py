"""Preference pairs as one prompt and two masked completions. Only DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tunequorum.llm.text import let

#: How a turn is rendered, and whose turns are trained on.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
TRAINED_ROLE = "assistant"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("")), F.lit(CLOSE))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def mask(turns: Column) -> Column:
    """Runs of the rendered turns as ``length:trained``, comma-joined; lengths in code points, trained 0 or 1."""
    def runs(t: Column) -> Column:
        trained = F.when(t["role"] == TRAINED_ROLE, F.lit("1")).otherwise(F.lit("0"))
        return F.concat(F.length(_head(t)).cast("string"), F.lit(":0,"), F.length(_body(t)).cast("string"), F.lit(":"), trained)

    return F.array_join(F.transform(turns, runs), ",")


def common_prefix(a: Column, b: Column) -> Column:
    """Number of turns, from the first on, in which role and text of both lists are the same."""
    n = F.least(F.size(a), F.size(b))

    def differs(k: Column) -> Column:
        x, y = F.get(a, k), F.get(b, k)
        return ~(x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]))

    first = F.get(F.filter(F.sequence(F.lit(0), n - 1), differs), F.lit(0))
    return F.when(n > 0, F.coalesce(first, n)).otherwise(F.lit(0))


def preference_pairs(
    turns: DataFrame, pair: Column, is_chosen: Column, turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(pair_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask): one row for each value of ``pair``.

    The common turns are rendered once as the prompt; the completions hold what follows, masked so that only text of
    TRAINED_ROLE is trained on. Turns are ordered by number, then role and text (null first); rows repeated in all of
    these count once. Where a side has no turns, nothing is common and its completion is empty; where both are equal,
    all is prompt. Null roles and texts are rendered as empty, but differ from empty ones. Rows without a pair or a
    side are left out. An empty table gives no rows.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    sided = turns.select(pair.alias("pair_id"), is_chosen.alias("side"), turn.alias("t")).where(
        F.col("pair_id").isNotNull() & F.col("side").isNotNull()
    )
    both = sided.groupBy("pair_id").agg(
        F.sort_array(F.collect_set(F.when(F.col("side"), F.col("t")))).alias("a"),
        F.sort_array(F.collect_set(F.when(~F.col("side"), F.col("t")))).alias("b"),
    )

    def formatted(n: Column) -> Column:
        def rest(side: Column) -> Column:
            return F.slice(side, n + 1, F.greatest(F.size(side) - n, F.lit(0)))

        a, b = F.col("a"), F.col("b")
        return F.struct(
            n.cast("long").alias("n_common"), render(F.slice(a, F.lit(1), n)).alias("prompt"),
            render(rest(a)).alias("chosen"), render(rest(b)).alias("rejected"),
            mask(rest(a)).alias("chosen_mask"), mask(rest(b)).alias("rejected_mask"),
        )

    return both.select("pair_id", let(common_prefix(F.col("a"), F.col("b")), formatted).alias("x")).select("pair_id", "x.*")
