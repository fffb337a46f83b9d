"""Masking of personal columns and leak checks.

Spark has no account groups, so membership is an argument. A published view or a masked copy hides
the values only from readers who cannot open the base files.
"""

from pyspark.sql import functions as F

from cutline import fixed_values as fixed
from cutline.functions.masking import masked


def mask_columns(df, is_member, columns=fixed.PROTECTED_COLUMNS):
    """The same rows with the protected columns masked unless the reader is a member."""
    may_see = F.lit(is_member) if isinstance(is_member, bool) else is_member
    return df.withColumns({name: masked(F.col(name), may_see) for name in columns})


def create_mask_function(spark, name, temporary=True):
    """SQL scalar function (value, is_member) -> value or mask text."""
    kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
    spark.sql(
        f"CREATE OR REPLACE {kind} {name}(val STRING, is_member BOOLEAN) RETURNS STRING "
        f"RETURN CASE WHEN is_member THEN val ELSE '{fixed.MASK_TEXT}' END"
    )


def publish_masked_view(spark, table, view, function, columns=fixed.PROTECTED_COLUMNS, is_member=False, temporary=False):
    """A view over the base table whose protected columns go through the mask function."""
    flag = "true" if is_member else "false"
    shown = [
        f"{function}(`{name}`, {flag}) AS `{name}`" if name in columns else f"`{name}`"
        for name in spark.table(table).columns
    ]
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {view} AS SELECT {', '.join(shown)} FROM {table}")
    return spark.table(view)


def masked_sample(view, limit=10):
    return view.select(
        *fixed.PROTECTED_COLUMNS, "seat_gender", "mhtcet_score", "institute_name"
    ).limit(limit)


def leaked_columns(df, protected=fixed.PROTECTED_COLUMNS):
    """Names of protected columns that an output still has."""
    return sorted(set(protected) & set(df.columns))


def leaked_values(output, column, base, protected="candidate_name"):
    """Rows of an output whose text equals a protected value of the base table.

    Both sides are hashed on the value; the protected side is reduced to distinct values first, so
    a value that fills a third of the base reaches the join once.
    """
    values = base.select(F.col(protected).alias("_protected")).where("_protected IS NOT NULL").distinct()
    return output.join(values, F.col(column) == F.col("_protected"), "left_semi")
