"""Silver tables: schemas, split and rejects; daily summary variants."""

from __future__ import annotations

from decimal import Decimal

import pytest

from tillstone.plans import silver, summary
from tillstone.sources.tables import bronze_detailed, bronze_summarized

DATA = "/root/testdata/sf0.001"
RUN = silver.Run(3, "2025-06-01 00:00:00")

# Published column counts and the types that differ from string.
COLUMN_COUNTS = {
    "summarized_invoices": 37, "summarized_credit_notes": 29, "detailed_invoices": 55, "detailed_credit_notes": 40,
}
TYPES = {
    "transaction_date": "date", "transaction_year": "int", "amount": "decimal(15,2)", "branch_code": "int",
    "source_processed_at": "timestamp_ntz", "is_credit_note": "int", "vat_calculated": "decimal(16,2)",
    "discount_percentage": "double", "quantity": "decimal(10,2)", "discount_percent": "decimal(5,2)",
    "calculated_line_total": "decimal(25,4)", "net_line_amount": "double", "potential_duplicate_flag": "int",
    "bronze_batch_id": "int", "silver_load_timestamp": "timestamp_ntz",
}


def tables(spark):
    s, d = bronze_summarized(spark, DATA), bronze_detailed(spark, DATA)
    return {
        "summarized_invoices": silver.summarized_invoices(s, RUN),
        "summarized_credit_notes": silver.summarized_credit_notes(s, RUN),
        "detailed_invoices": silver.detailed_invoices(d, RUN),
        "detailed_credit_notes": silver.detailed_credit_notes(d, RUN),
    }


def test_schemas(spark):
    for name, df in tables(spark).items():
        assert len(df.columns) == COLUMN_COUNTS[name], name
        found = dict(df.dtypes)
        assert {c: found[c] for c in TYPES if c in found} == {c: t for c, t in TYPES.items() if c in found}


@pytest.mark.parametrize("grain,view", [(silver.SUMMARIZED, bronze_summarized), (silver.DETAILED, bronze_detailed)])
def test_split_is_complete(spark, grain, view):
    bronze = view(spark, DATA)
    parts = [df.count() for df in silver.split_invoices(bronze, grain, RUN)]
    assert sum(parts) == bronze.count() and all(parts)
    by_type = [df.count() for df in silver.split_invoices(bronze, grain, RUN, policy="document_type")]
    assert sum(by_type) == bronze.count()


def bronze(spark, **changes):
    row = {
        "DOCUMENT_NUMBER": "INV1", "ITEM_CODE": " P1", "CUS_CODE": "C", "TRN_DATE": "2025-01-31", "AMOUNT": 10.0,
        "QUANTITY": 2.0, "ITEM_PRICE": 5.0, "DISCOUNT_PERCENT": 10.0, "BCODE": "7", "TELEPHONE": "+2 5-4",
        "source_file_path": "f", "load_timestamp": None, "batch_id": 1, **changes,
    }
    schema = (
        "DOCUMENT_NUMBER string, ITEM_CODE string, CUS_CODE string, TRN_DATE string, AMOUNT double, QUANTITY double, "
        "ITEM_PRICE double, DISCOUNT_PERCENT double, BCODE string, TELEPHONE string, source_file_path string, "
        "load_timestamp timestamp_ntz, batch_id int"
    )
    return spark.createDataFrame([row], schema)


def test_line_figures(spark):
    line = silver.detailed_invoices(bronze(spark), RUN).first()
    assert line.invoice_line_identifier == "INV1_P1"
    assert (line.calculated_line_total, line.effective_amount) == (Decimal("10.0000"), Decimal("10.0000"))
    assert (line.discounted_unit_price, line.net_line_amount) == (4.5, 9.0)
    assert line.customer_phone == "2 5-4" and line.company_name is None


def test_overflow_and_missing_price(spark):
    line = silver.detailed_invoices(bronze(spark, DISCOUNT_PERCENT=1000.0, ITEM_PRICE=None), RUN).first()
    assert line.discount_percent is None and line.price_invalid_flag == 1
    assert line.effective_amount == Decimal("10.0000") and line.net_line_amount is None


def test_positive_credit_number_stays_an_invoice(spark):
    line = silver.detailed_invoices(bronze(spark, DOCUMENT_NUMBER="CN9"), RUN).first()
    assert (line.is_credit_note, line.document_type) == (1, "CREDIT_NOTE")
    assert silver.detailed_credit_notes(bronze(spark, DOCUMENT_NUMBER="cn9"), RUN).count() == 0


def test_credit_notes(spark):
    note = silver.detailed_credit_notes(bronze(spark, AMOUNT=-3.0, QUANTITY=-2.0), RUN).first()
    assert (note.credit_amount, note.credit_calculated_total) == (Decimal("3.00"), Decimal("-10.0000"))
    zero = silver.detailed_credit_notes(bronze(spark, AMOUNT=0.0), RUN).first()
    assert zero.credit_note_type == "ZERO_AMOUNT"


def test_blank_item_code_is_kept_and_rejects_have_a_reason(spark):
    assert silver.detailed_invoices(bronze(spark, ITEM_CODE=""), RUN).count() == 1
    for change, reason in (
        ({"DOCUMENT_NUMBER": None}, "DOCUMENT_NUMBER_MISSING"), ({"ITEM_CODE": None}, "ITEM_CODE_MISSING"),
        ({"AMOUNT": None}, "AMOUNT_UNREADABLE"), ({"AMOUNT": 1e15}, "AMOUNT_UNREADABLE"),
    ):
        assert silver.rejects(bronze(spark, **change), silver.DETAILED).first().reject_reason == reason


def test_summary_credit_matching(spark):
    invoices = silver.detailed_invoices(bronze(spark), RUN)
    credits = silver.detailed_credit_notes(bronze(spark, AMOUNT=-3.0), RUN)
    documents = silver.summarized_invoices(bronze(spark), RUN)
    notes = silver.summarized_credit_notes(bronze(spark, AMOUNT=-4.0), RUN)
    both = summary.daily_sales_summary((documents, notes), (invoices, credits), RUN.load_timestamp)
    assert sorted((r.data_source, str(r.net_sales)) for r in both.collect()) == [
        ("DETAILED", "6.00"), ("DETAILED", "7.00"), ("SUMMARIZED", "6.00"), ("SUMMARIZED", "7.00"),
    ]
    own = summary.daily_sales_summary(
        (documents, notes), (invoices, credits), RUN.load_timestamp, match_source=True
    )
    assert sorted((r.data_source, str(r.net_sales)) for r in own.collect()) == [
        ("DETAILED", "7.00"), ("SUMMARIZED", "6.00"),
    ]
    single = summary.daily_sales_summary(None, (invoices, credits), RUN.load_timestamp)
    assert [r.credit_note_count for r in single.collect()] == [1]
    assert len(single.columns) == 18
