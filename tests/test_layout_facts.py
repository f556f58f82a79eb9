"""Facts of a sheet are worked out once, however many proposals are held against it."""

from gaugeworks import queries_rules
from gaugeworks.plans import resolve_layout


def test_proposals_share_what_is_known_of_a_sheet(spark, monkeypatch):
    calls = []
    last_row = resolve_layout._last_row
    monkeypatch.setattr(resolve_layout, "_last_row", lambda *a: calls.append(a) or last_row(*a))
    book = queries_rules._book(spark, "/root/testdata/sf0.001", merged=True)
    found = resolve_layout.resolve_layout(queries_rules._layout(), book, "CI042")
    said = {k: queries_rules._outcome(lambda c=c: resolve_layout.resolve_layout(queries_rules._layout(**c), book, "CI042")) for k, c in queries_rules._LAYOUTS.items() if k in ("another header", "header rows apart", "text as weight", "formula as weight")}
    assert found.plan.grouping == "merged_rows" and set(said.values()) == {"layout_error"}
    n = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").count()
    assert (found.header_rows, found.last_row) == ((2, 3), n + 3)
    assert len(calls) == 1
    book.release()
