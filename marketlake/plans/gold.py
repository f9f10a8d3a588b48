"""Gold facts: returns, volatility and rolling averages of prices; yearly changes of macro series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.columns import change, relative_change
from marketlake.operators.ordering import MAX_GROUP_ROWS
from marketlake.operators.rolling import HELPERS, fixed_point, frame_mean, returns, running_totals, totals_before
from marketlake.operators.series import over_series

#: Columns of price facts that follow from the others of their row.
DERIVED = ("daily_return", "stock_id")

# A series holds one row per calendar day or year, so the calendar bounds it: three centuries of days.
DAYS_OF_SERIES, YEARS_OF_SERIES = 110_000, 10_000


def _daily_return(dtype: T.DataType) -> Column:
    close, before = F.col("close_price"), F.col("prev_close_price")
    return returns(close, before, dtype) if fixed_point(dtype) else relative_change(close, before).cast("double")


def _series_id() -> Column:
    return F.concat(F.lit("STK_"), F.col("ticker"))


def derive_facts(facts: DataFrame) -> DataFrame:
    """Price facts with the columns of ``DERIVED``, for facts that were moved without them."""
    values = dict(zip(DERIVED, (_daily_return(facts.schema["close_price"].dataType), _series_id())))
    at = facts.columns.index("prev_close_price") + 1
    first, rest = facts.columns[:at], [c for c in facts.columns[at:] if c not in values]
    end = rest.index("stock_90_day_average") + 1
    return facts.select(
        *first, values["daily_return"].alias("daily_return"), *rest[:end], values["stock_id"].alias("stock_id"), *rest[end:]
    )


def stock_facts(
    prices: DataFrame,
    key: str = "ticker",
    time: str = "date",
    id_col: str | None = "stock_id",
    vol_rows: int = 30,
    avg_rows: int = 90,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Daily return, 30-row sample volatility and 90-row average close per ticker.

    ``prices`` is unique on (``key``, ``time``). Previous close, volatility and average share one
    shuffle and one sort. Returns and averages of fixed-point closes (the silver type) are exact and
    rounded to six places; other types are computed in doubles.
    """
    base = prices.select(
        *([F.col(id_col).alias("UUID")] if id_col else []),
        F.col(key).alias("ticker"),
        F.col(time).alias("trade_date"),
        *[F.col(c).alias(f"{c}_price") for c in ("open", "high", "low", "close")],
        F.col("volume").alias("stock_volume"),
    )

    dtype = base.schema["close_price"].dataType
    close = F.col("close_price")

    def metrics(df, w):
        # Two window passes: the second one needs the results of the first.
        prev = {"prev_close_price": F.lag(close).over(w)}
        volatility = {"volatility_days_30": F.stddev_samp("daily_return").over(w.rowsBetween(1 - vol_rows, 0))}
        if not fixed_point(dtype):
            mean = F.avg(close).over(w.rowsBetween(1 - avg_rows, 0)).cast("double")
            df = df.withColumns(prev).withColumn("daily_return", _daily_return(dtype))
            return df.withColumns(volatility | {"stock_90_day_average": mean})
        df = df.withColumns(prev | running_totals("close_price", dtype, w))
        df = df.withColumn("daily_return", _daily_return(dtype))
        df = df.withColumns(volatility | totals_before(avg_rows, w))
        return df.withColumn("stock_90_day_average", frame_mean(dtype)).drop(*HELPERS)

    at_most = DAYS_OF_SERIES if base.schema["trade_date"].dataType == T.DateType() else None
    facts = over_series(base, ["ticker"], "trade_date", max(vol_rows, avg_rows), metrics, max_group_rows, at_most)
    return facts.withColumn("stock_id", _series_id())


def macro_facts(
    macro: DataFrame,
    key: str = "country_code",
    time: str = "year",
    id_col: str | None = "data_id",
    compat: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Year-on-year rates of GDP and differences of inflation and unemployment per country.

    ``compat`` reports the inflation difference as the unemployment change, as older reports do.
    """
    base = macro.select(
        *([F.col(id_col).alias("UUID")] if id_col else []),
        F.col(key).alias("country_code"),
        "country_name",
        F.col(time).alias("data_point_year"),
        "nominal_gdp",
        "real_gdp",
        "inflation",
        "unemployment",
    )

    measures = ("nominal_gdp", "real_gdp", "inflation", "unemployment")

    def metrics(df, w):
        df = df.withColumns({f"prev_{c}": F.lag(c).over(w) for c in measures})
        now = {c: (F.col(c), F.col(f"prev_{c}")) for c in measures}
        return df.withColumns(
            {
                "year_on_year_gdp_change": relative_change(*now["nominal_gdp"]),
                "year_on_real_gdp_change": relative_change(*now["real_gdp"]),
                "inflation_change_year_on_year": change(*now["inflation"]),
                "unemployment_change_year_on_year": change(*now["inflation" if compat else "unemployment"]),
            }
        ).drop(*[f"prev_{c}" for c in measures])

    return over_series(base, ["country_code"], "data_point_year", 1, metrics, max_group_rows, YEARS_OF_SERIES)


def register_gold(spark: SparkSession, silver_db: str = "silver") -> dict[str, DataFrame]:
    """Temporary views ``stock_facts`` and ``macro_facts`` over the silver tables."""
    facts = {
        "stock_facts": stock_facts(spark.table(f"{silver_db}.ohclv_silver")),
        "macro_facts": macro_facts(spark.table(f"{silver_db}.macro_economic_data_silver")),
    }
    for name, df in facts.items():
        df.createOrReplaceTempView(name)
    return facts


def create_gold_views(spark: SparkSession, silver_db: str = "silver", gold_db: str = "gold") -> None:
    """Catalog views ``stock_facts`` and ``macro_facts``, evaluated when they are read.

    A view keeps each series in one task. That is bounded here: the silver contract allows one row
    per ticker and calendar day, and silver macro rows are unique per country and year.
    """
    series = "OVER (PARTITION BY ticker ORDER BY date)"
    frame = "OVER (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"
    spark.sql(f"""
        CREATE OR REPLACE VIEW {gold_db}.stock_facts AS
        WITH priced AS (
            SELECT stock_id AS UUID, 'STK_' || ticker AS stock_id, ticker, date AS trade_date,
                   open AS open_price, high AS high_price, low AS low_price, close AS close_price,
                   volume AS stock_volume, LAG(close) {series} AS prev_close_price
            FROM {silver_db}.ohclv_silver
        ), returns AS (
            SELECT *, CAST(close_price - prev_close_price AS DECIMAL(28,10)) / NULLIF(prev_close_price, 0) AS change
            FROM priced
        ), rounded AS (
            SELECT * EXCEPT (change), CAST(ROUND(change, 6) AS DOUBLE) AS daily_return FROM returns
        )
        SELECT *, STDDEV_SAMP(daily_return) {frame.format(29)} AS volatility_days_30,
               CAST(AVG(close_price) {frame.format(89)} AS DOUBLE) AS stock_90_day_average
        FROM rounded
    """)
    previous = ", ".join(
        f"NULLIF(LAG({c}) OVER (PARTITION BY country_code ORDER BY year), 0) AS prev_{c}"
        for c in ("nominal_gdp", "real_gdp", "inflation", "unemployment")
    )
    spark.sql(f"""
        CREATE OR REPLACE VIEW {gold_db}.macro_facts AS
        WITH series AS (SELECT *, {previous} FROM {silver_db}.macro_economic_data_silver)
        SELECT data_id AS UUID, country_code, country_name, year AS data_point_year,
               nominal_gdp, real_gdp, inflation, unemployment,
               (nominal_gdp - prev_nominal_gdp) / prev_nominal_gdp AS year_on_year_gdp_change,
               (real_gdp - prev_real_gdp) / prev_real_gdp AS year_on_real_gdp_change,
               inflation - prev_inflation AS inflation_change_year_on_year,
               unemployment - prev_unemployment AS unemployment_change_year_on_year
        FROM series
    """)
