"""User profile cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values that define the profile features.
CURRENT_YEAR = 2025          # reference year for ages
MAX_AGE, MIN_AGE = 90, 14    # valid birth years: [CURRENT_YEAR - 90, CURRENT_YEAR - 14]
FALLBACK_AGE = 30            # used when no valid birth year exists
BIRTH_YEAR_FLOOR = 1960      # profile feature clamps earlier years to this
MIN_SIGNUP_AGE = 16


def nearest_median(df: DataFrame, c: str) -> DataFrame:
    """One-row frame ``__q`` = the element at 0-based sorted position
    floor(n/2) of the non-null values (median with 'nearest' rounding).

    Runs on per-value counts (map-side combined), so only the distinct
    values meet in the final ordered pass; meant for small domains such as
    years."""
    counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("__c"))
    w = Window.orderBy(c).rowsBetween(Window.unboundedPreceding, 0)
    cum = counts.select(c, "__c", F.sum("__c").over(w).alias("__cum"),
                        F.sum("__c").over(Window.partitionBy()).alias("__n"))
    return (cum.where(F.col("__cum") >= F.floor(F.col("__n") / 2) + 1)
            .agg(F.min(c).alias("__q")))


def clean_birth_year(users: DataFrame, birth_year: str = "user_birth_year") -> DataFrame:
    """Out-of-range or null birth years -> median of the valid ones (or
    CURRENT_YEAR - FALLBACK_AGE), truncated to int."""
    lo, hi = CURRENT_YEAR - MAX_AGE, CURRENT_YEAR - MIN_AGE
    valid = F.col(birth_year).between(lo, hi)
    med = users.where(valid).agg(F.median(birth_year).alias("__med"))
    fill = F.coalesce(F.col("__med"), F.lit(float(CURRENT_YEAR - FALLBACK_AGE)))
    return (users.crossJoin(F.broadcast(med))  # one row
            .withColumn(birth_year, F.when(valid, F.col(birth_year).cast("double")).otherwise(fill).cast("int"))
            .drop("__med"))


def user_profile(users: DataFrame, user: str = "user_id_hashed", gender: str = "user_gender",
                 birth_year: str = "user_birth_year", tenure: str = "user_tenure_in_days") -> DataFrame:
    """user, gender, user_age, user_sign_up_age, tenure.

    Birth years before 1960 are clamped, nulls take the nearest-rank median;
    users whose implied sign-up age is under 16 are aged up to 16 + tenure."""
    q = nearest_median(users, birth_year)
    d = users.crossJoin(F.broadcast(q))  # one row
    by = F.col(birth_year)
    year = F.when(by.isNotNull(), F.when(by < BIRTH_YEAR_FLOOR, F.lit(BIRTH_YEAR_FLOOR)).otherwise(by)) \
        .otherwise(F.col("__q"))
    age = (F.lit(CURRENT_YEAR) - year).cast("double")
    yrs = F.col(tenure) / 365.0
    young = (age - yrs) < MIN_SIGNUP_AGE
    d = d.withColumn("user_age", F.when(young, MIN_SIGNUP_AGE + yrs).otherwise(age))
    d = d.withColumn("user_sign_up_age", F.col("user_age") - yrs)
    return d.select(user, gender, "user_age", "user_sign_up_age", tenure)
