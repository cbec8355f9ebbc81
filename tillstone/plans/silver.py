"""Silver sales tables: cleaned invoices and credit notes at document and line grain."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.functions.casts import ColumnCasts, email, is_blank, phone_all, phone_first
from tillstone.operators.duplicates import flag_by_position, flag_duplicates

SUMMARIZED = "summarized"
DETAILED = "detailed"

# Markers in documents and tables.
CREDIT_PREFIX = "CN"
CREDIT_NOTE = "CREDIT_NOTE"
INVOICE = "INVOICE"
ZERO_AMOUNT = "ZERO_AMOUNT"

# Keys that mark a line or document as a possible repeat, in bronze and in silver.
BRONZE_KEYS = {
    SUMMARIZED: ["DOCUMENT_NUMBER", "CUS_CODE", "TRN_DATE", "AMOUNT"],
    DETAILED: ["DOCUMENT_NUMBER", "ITEM_CODE", "TRN_DATE", "AMOUNT"],
}
LINE_KEYS = ["invoice_number", "product_code", "transaction_date", "amount"]
LINE_ORDER = ["load_timestamp", "source_file_path"]
DUPLICATE_FLAG = "potential_duplicate_flag"


@dataclass(frozen=True)
class Run:
    """Values stamped on every silver row of one run."""

    process_id: int
    load_timestamp: str
    phone_digits: str = "first"


def _phone(casts: ColumnCasts, run: Run) -> Column:
    cleaner = phone_all if run.phone_digits == "all" else phone_first
    return cleaner(casts.raw("TELEPHONE"))


def looks_like_credit(casts: ColumnCasts) -> Column:
    """Credit-note number or negative amount; an unknown amount does not count."""
    by_number = F.coalesce(casts.raw("DOCUMENT_NUMBER").startswith(CREDIT_PREFIX), F.lit(False))
    by_amount = F.coalesce(casts.number("AMOUNT") < 0, F.lit(False))
    return by_number | by_amount


def document_type(casts: ColumnCasts) -> Column:
    return F.when(looks_like_credit(casts), CREDIT_NOTE).otherwise(INVOICE)


def quality_flags(amount: Column, day: Column, customer: Column) -> dict[str, Column]:
    return {
        "amount_invalid_flag": amount.isNull().cast("int"),
        "date_invalid_flag": day.isNull().cast("int"),
        "customer_missing_flag": is_blank(customer).cast("int"),
    }


def line_quality_flags(quantity: Column, price: Column) -> dict[str, Column]:
    def not_positive(value: Column) -> Column:
        return (value.isNull() | (value <= 0)).cast("int")

    return {"quantity_invalid_flag": not_positive(quantity), "price_invalid_flag": not_positive(price)}


# Casts that several silver columns build on. They are made once, in their own projection: Spark
# keeps it apart from the next one, so a cast is neither repeated nor does one projection grow
# past what the JVM compiles.
_AMOUNT, _CREDIT, _DAY, _QUANTITY, _PRICE = "__amount", "__credit", "__day", "__quantity", "__price"


def _with_shared_casts(bronze: DataFrame, grain: str) -> DataFrame:
    casts = ColumnCasts(bronze)
    shared = {
        _AMOUNT: casts.money("AMOUNT"), _CREDIT: looks_like_credit(casts), _DAY: casts.day("TRN_DATE"),
    }
    if grain == DETAILED:
        shared |= {_QUANTITY: casts.quantity("QUANTITY"), _PRICE: casts.money("ITEM_PRICE")}
    return bronze.filter(_usable(bronze, grain, casts)).withColumns(shared)


def _customer(casts: ColumnCasts) -> dict[str, Column]:
    return {"customer_code": casts.text("CUS_CODE"), "customer_name": casts.text("CUSTOMER_NAME")}


def _calendar(casts: ColumnCasts) -> dict[str, Column]:
    return {
        "transaction_date": casts.transaction_day("TRN_DATE", F.col(_DAY)),
        "transaction_year": casts.integer("TRN_YEAR"),
        "transaction_month": casts.integer("TRN_MONTH"),
    }


def _branch(casts: ColumnCasts) -> dict[str, Column]:
    return {
        "branch_code": casts.integer("BCODE"),
        "cashier_username": casts.text("USERNAME"),
        "branch_name": casts.text("BRANCH_NAME"),
        "mpesa_till_number": casts.text("MPESA_TILL"),
    }


def _contact(casts: ColumnCasts, run: Run) -> dict[str, Column]:
    return {
        "customer_phone": _phone(casts, run),
        "customer_email": email(casts.raw("EMAIL")),
        "company_name": casts.text("COMPANY"),
        "customer_address": casts.text("ADDRESS"),
        "source_system": casts.text("_source_sheet"),
    }


def _load(casts: ColumnCasts) -> dict[str, Column]:
    return {
        "source_file_path": casts.raw("source_file_path"),
        "bronze_load_timestamp": casts.raw("load_timestamp"),
        "bronze_batch_id": casts.raw("batch_id"),
    }


def _originals(casts: ColumnCasts, names: list[str]) -> dict[str, Column]:
    return {f"original_{name.lower()}": casts.raw(name) for name in names}


def _line_details(casts: ColumnCasts, prefix: str = "") -> dict[str, Column]:
    """Item columns of a line; on credit notes the money columns lose their sign, the rest keep it."""
    unsigned = F.abs if prefix else (lambda value: value)
    return {
        f"{prefix}tax_amount": unsigned(casts.money("TAX_AMOUNT")),
        f"{prefix}quantity": F.col(_QUANTITY),
        f"{prefix}discount_percent": casts.percent("DISCOUNT_PERCENT"),
        f"{prefix}line_discount": unsigned(casts.money("DISCOUNT")),
        f"{prefix}product_description": casts.text("DESCRIPTION"),
        f"{prefix}unit_price": F.col(_PRICE),
        f"{prefix}price_weight": casts.text("PW"),
        f"{prefix}price_weight_quantity": casts.quantity("PWQTY"),
        f"{prefix}transaction_type": casts.text("TRN_TYPE"),
    }


def _invoice_amounts(casts: ColumnCasts) -> dict[str, Column]:
    amount = F.col(_AMOUNT)
    return {
        "amount": F.when(F.col(_CREDIT), F.abs(amount)).otherwise(amount),
        "amount_inclusive": casts.money("AMOUNT_INCLUSIVE"),
        "amount_exclusive": casts.money("AMOUNT_EXCLUSIVE"),
        "vat_amount": casts.money("VAT"),
        "discount_amount": casts.money("DISC"),
    }


def _credit_amounts(casts: ColumnCasts) -> dict[str, Column]:
    return {f"credit_{name}": F.abs(value) for name, value in {
        "amount": F.col(_AMOUNT),
        "amount_inclusive": casts.money("AMOUNT_INCLUSIVE"),
        "amount_exclusive": casts.money("AMOUNT_EXCLUSIVE"),
        "vat_amount": casts.money("VAT"),
        "discount_amount": casts.money("DISC"),
    }.items()}


def _stamp(run: Run) -> dict[str, Column]:
    return {
        "silver_load_timestamp": F.lit(run.load_timestamp).cast("timestamp_ntz"),
        "silver_process_id": F.lit(run.process_id).cast("int"),
    }


def _select(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select([column.alias(name) for name, column in columns.items()])


def _usable(bronze: DataFrame, grain: str, casts: ColumnCasts) -> Column:
    usable = casts.raw("DOCUMENT_NUMBER").isNotNull()
    return usable & casts.raw("ITEM_CODE").isNotNull() if grain == DETAILED else usable


def _is_credit_row() -> Column:
    return (F.col("document_type") == CREDIT_NOTE).cast("int")


def _line_id(document: str) -> Column:
    """NULL when either part is NULL."""
    return F.concat(F.col(document), F.lit("_"), F.col("product_code"))


def line_calculations() -> dict[str, Column]:
    quantity, price = F.col("quantity"), F.col("unit_price")
    kept_share = 1 - F.coalesce(F.col("discount_percent"), F.lit(0)).cast("double") / 100
    total = (quantity * price).cast("decimal(25,4)")
    return {
        "calculated_line_total": total,
        "effective_amount": F.when((quantity > 0) & (price > 0), total).otherwise(
            F.col("amount").cast("decimal(25,4)")
        ),
        "discounted_unit_price": price.cast("double") * kept_share,
        "net_line_amount": total.cast("double") * kept_share,
    }


def invoice_calculations() -> dict[str, Column]:
    exclusive = F.col("amount_exclusive")
    ratio = F.col("discount_amount").cast("double") / exclusive.cast("double") * 100
    return {
        "vat_calculated": F.col("amount_inclusive") - exclusive,
        "discount_percentage": F.when(exclusive > 0, ratio).otherwise(F.lit(0.0)),
    }


def clean_summarized(bronze: DataFrame, run: Run) -> DataFrame:
    """Typed invoice columns of every usable document, before the split."""
    rows = _with_shared_casts(bronze, SUMMARIZED)
    casts = ColumnCasts(rows)
    cleaned = _select(rows, {
        "invoice_number": casts.text("DOCUMENT_NUMBER"),
        "document_type": F.when(F.col(_CREDIT), CREDIT_NOTE).otherwise(INVOICE),
        **_customer(casts),
        **_calendar(casts),
        **_invoice_amounts(casts),
        **_branch(casts),
        **_contact(casts, run),
        "source_processed_at": casts.timestamp("_processed_at"),
        **quality_flags(F.col(_AMOUNT), F.col(_DAY), casts.raw("CUS_CODE")),
        **_load(casts),
        **_originals(casts, ["DOCUMENT_NUMBER", "CUS_CODE", "CUSTOMER_NAME", "TRN_DATE"]),
    })
    return cleaned.withColumns({**_stamp(run), "is_credit_note": _is_credit_row(), **invoice_calculations()})


def clean_detailed(bronze: DataFrame, run: Run, carry: Sequence[str] = ()) -> DataFrame:
    """Typed line columns of every usable line, before the split; ``carry`` passes columns through."""
    rows = _with_shared_casts(bronze, DETAILED)
    casts = ColumnCasts(rows)
    cleaned = _select(rows, {
        "invoice_number": casts.text("DOCUMENT_NUMBER"),
        "product_code": casts.text("ITEM_CODE"),
        "document_type": F.when(F.col(_CREDIT), CREDIT_NOTE).otherwise(INVOICE),
        **_customer(casts),
        **_calendar(casts),
        **_invoice_amounts(casts),
        **_line_details(casts),
        "amount_value": casts.money("AMOUNT_VALUE"),
        "amount_excl": casts.money("AMT_EXCL"),
        **_branch(casts),
        **_contact(casts, run),
        "source_processed_at": casts.timestamp("_processed_at"),
        **quality_flags(F.col(_AMOUNT), F.col(_DAY), casts.raw("CUS_CODE")),
        **line_quality_flags(F.col(_QUANTITY), F.col(_PRICE)),
        **_load(casts),
        **_originals(casts, ["DOCUMENT_NUMBER", "ITEM_CODE", "CUS_CODE", "DESCRIPTION"]),
        **{name: casts.raw(name) for name in carry},
    })
    return cleaned.withColumns({
        "invoice_line_identifier": _line_id("invoice_number"),
        **_stamp(run),
        "is_credit_note": _is_credit_row(),
        **line_calculations(),
    })


def summarized_invoices(bronze: DataFrame, run: Run) -> DataFrame:
    """Documents with a positive amount."""
    casts = ColumnCasts(bronze)
    return clean_summarized(bronze.filter(casts.money("AMOUNT") > 0), run)


def line_keys(casts: ColumnCasts) -> dict[str, Column]:
    """What makes two positive lines repeats of each other, derived from bronze columns by name."""
    names = ("DOCUMENT_NUMBER", "ITEM_CODE", "TRN_DATE", "AMOUNT")
    values = (casts.text(names[0]), casts.text(names[1]), casts.transaction_day(names[2]), casts.money(names[3]))
    return dict(zip(LINE_KEYS, values))


def detailed_invoices(
    bronze: DataFrame, run: Run, row_id: Sequence[str] | None = None, position: tuple[str, str] | None = None
) -> DataFrame:
    """Lines with a positive amount, with a flag on repeats of a line.

    Lines are flagged before they are cleaned, so the shuffle carries the narrower bronze rows.
    ``row_id`` names bronze columns that identify a row, such as the file and row position that
    ``read_with_row_id`` adds. Passing them saves folding exact copies first. ``position`` names a file and
    a row index instead; then first rows are found at once, and whole rows are not shuffled at all.
    """
    casts = ColumnCasts(bronze)
    positive = bronze.filter(_usable(bronze, DETAILED, casts) & (casts.money("AMOUNT") > 0))
    keys = line_keys(ColumnCasts(positive))
    if position is not None:
        flagged = flag_by_position(positive, keys, LINE_ORDER, position, DUPLICATE_FLAG)
    else:
        flagged = flag_duplicates(positive, keys, LINE_ORDER, row_id, DUPLICATE_FLAG)
    return clean_detailed(flagged, run, carry=[DUPLICATE_FLAG])


def _credit_type() -> Column:
    return F.when(F.col("credit_amount") == 0, ZERO_AMOUNT).otherwise(CREDIT_NOTE)


def _credit_rows(bronze: DataFrame, grain: str) -> DataFrame:
    return _with_shared_casts(bronze.filter(ColumnCasts(bronze).money("AMOUNT") <= 0), grain)


def summarized_credit_notes(bronze: DataFrame, run: Run) -> DataFrame:
    """Documents with a zero or negative amount; amounts lose their sign."""
    rows = _credit_rows(bronze, SUMMARIZED)
    casts = ColumnCasts(rows)
    credits = _select(rows, {
        "credit_note_number": casts.text("DOCUMENT_NUMBER"),
        **_customer(casts),
        **_calendar(casts),
        **_credit_amounts(casts),
        **_branch(casts),
        **_contact(casts, run),
        **_load(casts),
        **_originals(casts, ["DOCUMENT_NUMBER", "CUS_CODE", "CUSTOMER_NAME"]),
    })
    return credits.withColumns({**_stamp(run), "credit_note_type": _credit_type()})


def detailed_credit_notes(bronze: DataFrame, run: Run) -> DataFrame:
    """Lines with a zero or negative amount; amounts lose their sign, quantity keeps it."""
    rows = _credit_rows(bronze, DETAILED)
    casts = ColumnCasts(rows)
    credits = _select(rows, {
        "credit_note_number": casts.text("DOCUMENT_NUMBER"),
        "product_code": casts.text("ITEM_CODE"),
        **_customer(casts),
        **_calendar(casts),
        **_credit_amounts(casts),
        **_line_details(casts, "credit_"),
        **_branch(casts),
        **_contact(casts, run),
        **_load(casts),
        **_originals(casts, ["DOCUMENT_NUMBER", "ITEM_CODE"]),
    })
    total = (F.col("credit_quantity") * F.col("credit_unit_price")).cast("decimal(25,4)")
    return credits.withColumns({
        "credit_line_identifier": _line_id("credit_note_number"),
        **_stamp(run),
        "credit_note_type": _credit_type(),
        "credit_calculated_total": total,
    })


def rejects(bronze: DataFrame, grain: str) -> DataFrame:
    """Rows that reach neither invoices nor credit notes, with the reason."""
    casts = ColumnCasts(bronze)
    reason = F.when(casts.raw("DOCUMENT_NUMBER").isNull(), "DOCUMENT_NUMBER_MISSING")
    if grain == DETAILED:
        reason = reason.when(casts.raw("ITEM_CODE").isNull(), "ITEM_CODE_MISSING")
    reason = reason.when(casts.money("AMOUNT").isNull(), "AMOUNT_UNREADABLE")
    return bronze.withColumn("reject_reason", reason).filter(F.col("reject_reason").isNotNull())


# Older split: a document is a credit note by its type, and zero amounts stay invoices.
_CREDIT_RENAMES = {
    name: f"credit_{name}"
    for name in (
        "amount", "amount_inclusive", "amount_exclusive", "vat_amount", "discount_amount",
        "vat_calculated", "discount_percentage", "tax_amount", "quantity", "discount_percent",
        "line_discount", "product_description", "product_code", "unit_price", "price_weight",
        "price_weight_quantity", "transaction_type", "effective_amount",
        "discounted_unit_price", "net_line_amount",
    )
} | {"calculated_line_total": "credit_calculated_total"}
_NOT_IN_OLD_CREDITS = [
    "document_type", "is_credit_note", "amount_invalid_flag", "date_invalid_flag",
    "customer_missing_flag", "quantity_invalid_flag", "price_invalid_flag", "source_file_path",
    "amount_value", "amount_excl",
]
_NOT_IN_OLD_TABLES = ["invoice_line_identifier"]


def split_by_document_type(bronze: DataFrame, grain: str, run: Run) -> tuple[DataFrame, DataFrame]:
    cleaned = (clean_detailed if grain == DETAILED else clean_summarized)(bronze, run)
    audit = [name for name in cleaned.columns if name.startswith("original_")]
    cleaned = cleaned.drop(*audit, *_NOT_IN_OLD_TABLES)
    invoices = cleaned.filter(F.col("is_credit_note") == 0)
    credits = cleaned.filter(F.col("is_credit_note") == 1).drop(*_NOT_IN_OLD_CREDITS)
    return invoices, credits.withColumnsRenamed(_CREDIT_RENAMES)


def split_invoices(
    bronze: DataFrame, grain: str, run: Run, policy: str = "amount"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Invoices, credit notes and rejects of one grain.

    ``policy="amount"`` splits on the sign of the amount, ``"document_type"`` on the document type.
    """
    if policy == "document_type":
        invoices, credits = split_by_document_type(bronze, grain, run)
        missing = bronze.filter(F.col("DOCUMENT_NUMBER").isNull())
        return invoices, credits, missing.withColumn("reject_reason", F.lit("DOCUMENT_NUMBER_MISSING"))
    if grain == DETAILED:
        return detailed_invoices(bronze, run), detailed_credit_notes(bronze, run), rejects(bronze, grain)
    return summarized_invoices(bronze, run), summarized_credit_notes(bronze, run), rejects(bronze, grain)
