"""Work on nested documents: paths, arrays, and lookups between collections."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold.operators.gather import push


def path_type(df: DataFrame, path: str) -> T.DataType:
    """Type of the column or nested field at ``path``."""
    return df.select(F.col(path)).schema[0].dataType


def put(df: DataFrame, path: str, value: Column) -> DataFrame:
    """Set a column, or a field inside a nested document."""
    head, _, rest = path.partition(".")
    return df.withColumn(head, F.col(head).withField(rest, value) if rest else value)


def unwind(df: DataFrame, path: str, fields: list[str] | None = None) -> DataFrame:
    """One row per array element, which takes the array's place.

    Rows whose array is missing, null or empty are left out; null elements stay.
    A field that is no array counts as its own single element. With ``fields`` the
    elements keep those fields only, and only those are read from the file.
    """
    if not isinstance(path_type(df, path), T.ArrayType):
        return df.where(F.col(path).isNotNull())
    array = F.col(path)
    if fields:
        leaves = [F.col(f"{path}.`{name}`").alias(name) for name in fields]
        array = F.arrays_zip(*leaves)
    if "." not in path:
        others = [F.explode(array).alias(path) if c == path else c for c in df.columns]
        return df.select(*others)
    exploded = df.select("*", F.explode(array).alias("unwound_element"))
    return put(exploded, path, F.col("unwound_element")).drop("unwound_element")


def map_fields(
    df: DataFrame,
    array: str,
    fields: dict[str, Callable[[Column], Column]],
    null_element: str = "keep",
) -> DataFrame:
    """Add or replace fields in every element of an array of documents.

    ``fields`` maps a name to a function of the element. A null element stays
    null, or with ``null_element="document"`` becomes a document of nulls with
    the given fields computed from it.
    """
    element = path_type(df, array).elementType
    blank = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in element])

    def merged(item: Column) -> Column:
        base = F.coalesce(item, blank) if null_element == "document" else item
        for name, value in fields.items():
            base = base.withField(name, value(item))
        return base

    return put(df, array, F.transform(F.col(array), merged))


def project_elements(
    df: DataFrame, array: str, fields: dict[str, Callable[[Column], Column]]
) -> DataFrame:
    """Replace every element of an array by a document of the given fields only."""

    def projected(item: Column) -> Column:
        return F.struct(*[value(item).alias(name) for name, value in fields.items()])

    return put(df, array, F.transform(F.col(array), projected))


def array_count(df: DataFrame, path: str, strict: bool = False) -> Column:
    """Number of elements of the array at ``path``.

    A missing array gives null, or raises with ``strict``. For an array of
    documents only its first leaf field is read from the file.
    """
    element = path_type(df, path).elementType
    leaf = path
    while isinstance(element, T.StructType):
        leaf = f"{leaf}.`{element[0].name}`"
        element = element[0].dataType
    missing = F.col(leaf).isNull()
    complaint = F.raise_error(F.lit(f"{path} is not an array")).cast("int")
    absent = complaint if strict else F.lit(None).cast("int")
    return F.when(missing, absent).otherwise(F.size(leaf))


def lookup(
    left: DataFrame,
    right: DataFrame,
    local: str,
    foreign: str,
    as_: str,
    columns: list[str | Column] | None = None,
    left_unique: bool = False,
) -> DataFrame:
    """Left outer join that nests the matching right rows in an array.

    ``local`` and ``as_`` may be paths into nested documents. Null keys match null
    keys. A left row comes once, without a match with an empty array. Where the array
    is to be unwound again, ``lookup_unwind`` builds none.
    Set ``left_unique`` if ``local`` is the key of ``left``, never null and never
    twice: the join then takes the gathered arrays as they lie. Otherwise they are
    shuffled once more, which lets Spark split a skewed key of ``left``.
    """
    keyed = right.withColumn("lookup_key", F.col(foreign))
    gathered = push(keyed, ["lookup_key"], columns or right.columns, "lookup_documents")
    key = gathered["lookup_key"]
    on = F.col(local) == key if left_unique else F.col(local).eqNullSafe(key)
    joined = left.join(gathered, on, "left")
    array_type = gathered.schema["lookup_documents"].dataType
    matches = F.coalesce("lookup_documents", F.array().cast(array_type))
    return put(joined, as_, matches).drop("lookup_documents", "lookup_key")


def lookup_unwind(
    left: DataFrame,
    right: DataFrame,
    local: str,
    foreign: str,
    as_: str,
    columns: list[str] | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """A lookup and unwind of its result in one: an inner join, no array is built.

    Each match is nested at ``as_``. Left rows without a match are left out. Set
    ``null_safe=False`` where keys are never null, to push ``IS NOT NULL`` into
    both scans. Which side is broadcast, and splitting of skewed keys, is left to
    the size checks of the adaptive planner.
    """
    wanted = columns or right.columns
    packed = right.select(
        F.col(foreign).alias("lookup_key"), F.struct(*wanted).alias("lookup_document")
    )
    key = packed["lookup_key"]
    on = F.col(local).eqNullSafe(key) if null_safe else F.col(local) == key
    joined = left.join(packed, on)
    return put(joined, as_, F.col("lookup_document")).drop("lookup_document", "lookup_key")
