"""From raw text frames to clean ones."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow import fixed_values as V
from tillflow import schemas as S
from tillflow.functions.flags import offer_flag
from tillflow.functions.text import canonical, clean_email, split_address


def union_batches(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Rows of all batches, duplicates kept, columns matched by name."""
    united = first
    for batch in rest:
        united = united.unionByName(batch)
    return united


# Lines of one sale agree in these; equal lines do in any case.
_SALE = ("transaction_id", "transaction_date", "customer_id")
_PRODUCT = ("product_id", "product_name", "product_category")
# Columns that the lines of a sale mostly share begin with these.
_SHARED = ("customer_", "shipping_", "payment_")
_SEPARATOR, _ESCAPE = "\x01", "\x02"


def clean_lines(raw: DataFrame) -> DataFrame:
    """Trimmed, renamed sales lines with parsed offers, copies kept.

    Values stay text (offers aside), each in one spelling, as the columns of one
    drop may disagree in type.
    """
    renamed = raw.select(list(V.SALES_COLUMNS)).withColumnsRenamed(V.SALES_RENAMES)
    columns = []
    for name in renamed.columns:
        text = F.trim(F.col(name))
        if name in V.OFFER_DISCOUNTS:
            text = offer_flag(text)
        elif name == "customer_email":
            text = F.trim(clean_email(F.col(name)))
        elif name in S.SALES_TEXT_TYPES:
            text = canonical(text, S.SALES_TEXT_TYPES[name])
        columns.append(text.alias(name))
    return renamed.select(columns)


def with_address_parts(lines: DataFrame) -> DataFrame:
    """Sales lines with the parts of their address."""
    return lines.withColumns(split_address(F.col("shipping_address")))


def clean_sales(raw: DataFrame) -> DataFrame:
    """Clean lines, each once, with address parts.

    One shuffle. Lines are dealt out by their sale, not by all columns: those of one sale stay side by
    side, so that the texts they share compress. All columns but the sale's and the product's are
    packed into one text for it, the customer's first: a row of many columns takes more, as each has
    an offset that differs. Those of the product stay, so that what is worked out by product needs
    no de-duplication; the planner drops it. The address is split behind the de-duplication, since its parts depend on a column that is
    already in the key.
    """
    lines = clean_lines(raw)
    kinds = dict(lines.dtypes)
    plain = [*_SALE, *_PRODUCT]
    packed = sorted(set(kinds) - set(plain), key=lambda c: (not c.startswith(_SHARED), c))
    rows = lines.select(*plain, F.concat_ws(_SEPARATOR, *map(_escaped, packed)).alias("others"))
    rows = rows.repartition(*_SALE).dropDuplicates()
    parts = rows.select(*plain, F.split("others", _SEPARATOR).alias("parts"))
    columns = {c: _unescaped(F.col("parts")[k]).cast(kinds[c]) for k, c in enumerate(packed)}
    return with_address_parts(parts.select([columns.get(c, F.col(c)).alias(c) for c in kinds]))


def _escaped(name: str) -> Column:
    """A column as text that has no separator; a null is a mark that no text gives."""
    text = F.replace(F.col(name).cast("string"), F.lit(_ESCAPE), F.lit(_ESCAPE + "e"))
    text = F.replace(text, F.lit(_SEPARATOR), F.lit(_ESCAPE + "s"))
    return F.coalesce(text, F.lit(_ESCAPE + "n"))


def _unescaped(part: Column) -> Column:
    text = F.replace(part, F.lit(_ESCAPE + "s"), F.lit(_SEPARATOR))
    text = F.replace(text, F.lit(_ESCAPE + "e"), F.lit(_ESCAPE))
    return F.when(part != _ESCAPE + "n", text)


def _clean_lookup(raw: DataFrame, columns, types) -> DataFrame:
    trimmed = {name: F.trim(F.col(name)) for name in columns}
    for name, type_name in types.items():
        trimmed[name] = canonical(trimmed[name], type_name)
    return raw.select([text.alias(name) for name, text in trimmed.items()])


def clean_agents(raw: DataFrame) -> DataFrame:
    """Trimmed sales agents."""
    return _clean_lookup(raw, V.AGENT_COLUMNS, S.AGENT_TEXT_TYPES)


def clean_branches(raw: DataFrame) -> DataFrame:
    """Trimmed branches."""
    return _clean_lookup(raw, V.BRANCH_COLUMNS, S.BRANCH_TEXT_TYPES)
