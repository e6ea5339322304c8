"""Observation ids and surrogate keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: text that stands for a null inside a surrogate key.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"


def with_six_digits(df: DataFrame, texts: Mapping[str, str]) -> DataFrame:
    """Add coordinates with six significant digits as text: 21.0, 105.789, 0.0123457, 1.5e-05.

    `texts` maps new columns to columns of doubles below 1000. Ties are judged on the exact binary value and go to the
    even digit: the product with a power of ten is split into its rounded part and the exact error (Dekker), as the
    rounded product alone can look like a tie that it is not. The steps are separate projections, since each value
    is used several times in the next one.
    """
    inner = {new: f"_{new}" for new in texts}
    powers = F.array(*[F.lit(float(10**n)) for n in range(10)])

    def stage(make: Callable[[str, Callable[[str], Column]], dict[str, Column]]) -> None:
        nonlocal df
        added: dict[str, Column] = {}
        for new, prefix in inner.items():
            at = lambda part, prefix=prefix: F.col(f"{prefix}_{part}")
            added |= {f"{prefix}_{part}": column for part, column in make(new, at).items()}
        df = df.withColumns(added)

    stage(lambda new, at: {"v": F.abs(F.col(texts[new]).cast("double"))})

    def digits(new: str, at) -> dict[str, Column]:
        n = F.when(at("v") >= 100, 3)
        for low, count in ((10.0, 4), (1.0, 5), (0.1, 6), (0.01, 7), (0.001, 8)):
            n = n.when(at("v") >= low, count)
        return {"n": n.otherwise(9)}

    stage(digits)
    stage(lambda new, at: {"p": F.element_at(powers, at("n") + 1), "wide": at("v") * F.lit(134217729.0)})
    stage(lambda new, at: {"x": at("v") * at("p"), "hi": at("wide") - (at("wide") - at("v"))})
    stage(
        lambda new, at: {
            "whole": F.floor(at("x")).cast("double"),
            "error": (at("hi") * at("p") - at("x")) + (at("v") - at("hi")) * at("p"),
        }
    )
    stage(lambda new, at: {"rest": at("x") - at("whole")})

    def rounded(new: str, at) -> dict[str, Column]:
        tie_up = (at("error") > 0) | ((at("error") == 0) & (at("whole") % 2 == 1))
        up = (at("rest") > 0.5) | ((at("rest") == 0.5) & tie_up)
        return {"k": (at("whole") + F.when(up, 1.0).otherwise(0.0)).cast("bigint"), "b": at("p").cast("bigint")}

    stage(rounded)

    def written(new: str, at) -> Column:
        units = ((at("k") - at("k") % at("b")) / at("b")).cast("bigint").cast("string")
        fraction = F.lpad((at("k") % at("b")).cast("string"), at("n"), F.lit("0"))
        fixed = F.concat(units, F.lit("."), F.regexp_replace(fraction, r"(?<=.)0+$", ""))
        tiny = F.regexp_replace(F.format_string("%.5e", at("v")), r"\.?0+e", "e")
        sign = F.when(F.col(texts[new]) < 0, "-").otherwise("")
        digits = F.concat(sign, F.when(at("v") >= 0.0001, fixed).otherwise(tiny))
        # A negative zero keeps its sign.
        return F.when(at("v") == 0, F.col(texts[new]).cast("string")).otherwise(digits)

    df = df.withColumns(
        {
            new: F.when(
                F.col(f"{prefix}_v").isNotNull(), written(new, lambda part, prefix=prefix: F.col(f"{prefix}_{part}"))
            )
            for new, prefix in inner.items()
        }
    )
    helpers = [c for c in df.columns if any(c.startswith(f"{prefix}_") for prefix in inner.values())]
    return df.drop(*helpers)


def with_observation_id(
    df: DataFrame, source: str, lat: str = "lat", lon: str = "lon", ts: str = "ts", alias: str = "observation_id"
) -> DataFrame:
    """Add the SHA-256 of source, coordinates and epoch seconds; null when one of them is null."""
    bar = F.lit("|")
    texts = with_six_digits(df, {"_lat6": lat, "_lon6": lon})
    text = F.concat(F.lit(source), bar, F.col("_lat6"), bar, F.col("_lon6"), bar, F.col(ts).cast("string"))
    return texts.withColumn(alias, F.sha2(text, 256)).drop("_lat6", "_lon6")


def surrogate_key(*columns: Column | str) -> Column:
    """MD5 of the columns' texts joined by '-', with a fixed text for nulls, so that (null, x) has a key too."""
    texts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_KEY_TEXT)) for c in columns
    ]
    return F.md5(F.concat_ws("-", *texts))
