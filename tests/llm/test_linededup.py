from quire.llm.linededup import line_dedup


def test_awkward_rows(documents):
    common = "  Shared LINE\t"
    rows = [(i, f"own {i}\n{common}\n\n{common}\nend {i}") for i in range(10)] + [(20, None), (21, ""), (22, "\n\n"), (None, "shared line\nalone"), (30, "only"), (30, "only"), (40, "x\n" * 5000 + "SHARED line")]
    got = {(r.row.doc_id, r.row.text): r for r in line_dedup(documents(rows, extra=True)).collect()}
    assert got[(3, rows[3][1])].kept_text == "own 3\n\nend 3" and got[(3, rows[3][1])].n_lines == 5 and got[(3, rows[3][1])].n_dropped == 2
    assert (got[(20, None)].n_lines, got[(20, None)].kept_text) == (1, "")
    assert got[(22, "\n\n")].kept_text == "\n\n"
    assert got[(None, "shared line\nalone")].kept_text == "alone"
    assert got[(40, rows[-1][1])].kept_text == "x\n" * 4999 + "x" and got[(40, rows[-1][1])].n_dropped == 1
    assert line_dedup(documents(rows)).count() == len(rows)


def test_threshold_counts_documents_not_lines(documents):
    rows = [(i, "nine") for i in range(9)] + [(9, "nine " + "\n".join(["many"] * 50))] * 3
    assert {r.n_dropped for r in line_dedup(documents(rows)).collect()} == {0}
    assert line_dedup(documents([])).count() == 0


def test_many_equal_rows_of_one_id(spark, documents):
    """Positions are kept once for all equal rows of an id, and of no id."""
    text = "own\n" + "\n".join(["shared"] * 50) + "\nlast"
    rows = [(i, f"shared\n{i}") for i in range(10)] + [(77, text)] * 400 + [(None, text)] * 400
    out = line_dedup(documents(rows))
    got = out.where("row.doc_id = 77 or row.doc_id is null").collect()
    assert len(got) == 800 and {(r.n_lines, r.n_dropped, r.kept_text) for r in got} == {(52, 50, "own\nlast")}
