import datetime as dt
import glob
import gzip
import os
import threading

import pytest
from pyspark.sql import functions as F

from ratemill import FACTOR, RENEWAL, STUMPAGE, ImportAborted, TableStore, import_files
from ratemill.operators import merge
from ratemill.operators.classify import classify_feed
from ratemill.plans import importer
from ratemill.plans.queries import WIDER
from ratemill.session import new_scratch, written, written_around
from ratemill.sources import lines
from ratemill.sources.import_log import read_import_log
from ratemill.sources.lines import (
    LINE_ORDER,
    file_table,
    list_files,
    number_lines,
    read_delimited,
    read_lines,
)
from ratemill.sources.store import Conflict, Version
from ratemill.streaming.folder import import_stream

STUMPAGE_HEADER = ",".join(STUMPAGE.names)
RENEWAL_HEADER = ",".join(RENEWAL.names)


def stumpage(rate_id, product, name="Name", rate="1.5", start="1042026", end="31032027"):
    return f'S,{rate_id},{product},"{name}",G,Group,R,"Rate, type",{rate},{start},{end}'


def renewal(rate_id, unit, group="G", rate="1.5"):
    return f"R,{rate_id},{unit},Unit,{group},Group,R,Rate,{rate},1042026,31032027"


def text(header, *lines, end="\n"):
    return end.join([header, *lines]) + end


def rows(store, spec, *columns):
    return {tuple(r) for r in store.read(spec).select(*columns).collect()}


# -- reading -------------------------------------------------------------------------------------


def test_parser_cases(spark, write, tmp_path):
    body = "\n  \nA,,a,A\r\n\nx\r1,2,3,4,5\n\" q \",\"1,000\"\n"
    write("f.csv", b"\xef\xbb\xbf" + body.encode())
    (raw,) = read_delimited(spark, [str(tmp_path / "in")], new_scratch(spark, "t"))
    assert raw.names == ("A", "Column_2", "a_2", "A_3")
    got = [tuple(r) for r in raw.df.orderBy(*LINE_ORDER).select(*raw.names).collect()]
    assert got == [("x", None, None, None), ("1", "2", "3", "4"), ("q", "1,000", None, None)]


def test_one_raw_table_per_header(spark, write, tmp_path):
    write("a.csv", "x,y\n1,2\n")
    write("b.csv", "x\n3\nx\n")
    write("c d/e.csv", "x,y\n5,6\n")
    tables = read_delimited(spark, [str(tmp_path / "in")], new_scratch(spark, "t"))
    got = {t.names: sorted(tuple(r) for r in t.df.select(*t.names).collect()) for t in tables}
    assert got == {("x",): [("3",), ("x",)], ("x", "y"): [("1", "2"), ("5", "6")]}


@pytest.mark.parametrize("content, problem", [("", "empty"), ("\n \n", "empty"), ("A_2,A,A\n1\n", "same name")])
def test_bad_files_are_errors(spark, write, content, problem):
    path = write("f.csv", content)
    with pytest.raises(ValueError, match=problem):
        read_delimited(spark, [path], new_scratch(spark, "t"))


def test_line_order_over_many_splits(spark, write):
    n = 5000
    paths = [write(f"{f}.txt", "".join(f"{f}:{i}\n" for i in range(n))) for f in ("b", "a")]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        files = list_files(spark, paths)
        assert [f.path.rsplit("/", 1)[1] for f in files] == ["b.txt", "a.txt"]
        scan = read_lines(spark, paths)
        assert scan.rdd.getNumPartitions() > 8
        table = scan.join(file_table(spark, files), "_file")
        table = written(table.select(*LINE_ORDER, "value"), new_scratch(spark, "t"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = [f"{f}:{i}" for f in ("b", "a") for i in range(n)]
    assert [r.value for r in table.orderBy(*LINE_ORDER).collect()] == want
    per_file = number_lines(table, table).collect()
    assert all(int(r.value[2:]) + 1 == r._line_no for r in per_file)
    across = number_lines(table, table, across_files=True).orderBy("_line_no").collect()
    assert [r.value for r in across] == want


@pytest.mark.parametrize(
    "names, feed",
    [
        (["MANAGEMENT_UNIT_CODE", "MANAGEMENT_UNIT_NAME", "PRODUCT_TYPE_CODE", "PRODUCT_TYPE_NAME"], "renewal"),
        (["product_type_code", "PRODUCT_TYPE_name"], "stumpage"),
        (["FACTOR_ID", "X", "TALLY_DESTINATION_CODE"], "factor"),
        (["FACTOR_ID", "PRODUCT_TYPE_CODE"], None),
    ],
)
def test_classification(spark, names, feed):
    column = classify_feed(F.array(*[F.lit(n) for n in names]))
    assert spark.range(1).select(column).first()[0] == feed


# -- importing -----------------------------------------------------------------------------------


def test_last_file_wins_in_the_order_given(spark, store, write):
    a = write("a.csv", text(STUMPAGE_HEADER, stumpage(1, "P", "from a"), stumpage(2, "P")))
    b = write("b.csv", text(STUMPAGE_HEADER, "", stumpage(3, "P"), stumpage(1, "P", "from b")))
    result = import_files(spark, [b, a], store)
    assert result.processed == {"stumpage": 4} and result.error_count == 0
    assert rows(store, STUMPAGE, "RATE_ID", "PRODUCT_TYPE_NAME", "ID") == {
        (3, "Name", 1),
        (1, "from a", 2),
        (2, "Name", 3),
    }
    row = store.read(STUMPAGE).where("RATE_ID = 1").first()
    assert (row.RATE_TYPE_NAME, row.RATE) == ("Rate, type", 1.5)
    assert (row.EFFECTIVE_DATE, row.EXPIRY_DATE) == (dt.date(2026, 4, 1), dt.date(2027, 3, 31))


def test_updates_inserts_and_untouched_rows(spark, store, write):
    first = write("1.csv", text(STUMPAGE_HEADER, *[stumpage(i, "P") for i in range(5)]))
    import_files(spark, [first], store)
    before = store.version()
    second = write("2.csv", text(STUMPAGE_HEADER, stumpage(9, "P"), stumpage(2, "P", rate="7")))
    assert import_files(spark, [second], store).processed == {"stumpage": 2}
    assert rows(store, STUMPAGE, "RATE_ID", "RATE", "ID") == {
        (0, 1.5, 1), (1, 1.5, 2), (2, 7.0, 3), (3, 1.5, 4), (4, 1.5, 5), (9, 1.5, 6),
    }
    # The version before is still whole.
    assert store.read(STUMPAGE, before).count() == 5
    # Files without a changed row are kept as they are.
    third = write("3.csv", text(STUMPAGE_HEADER, stumpage(9, "P", rate="8")))
    files = store.version().files["stumpage_rates"]
    import_files(spark, [third], store)
    assert len(set(files) & set(store.version().files["stumpage_rates"])) == len(files) - 1


def test_same_file_twice(spark, store, write):
    path = write("s.csv", text(STUMPAGE_HEADER, stumpage(1, "P"), stumpage(2, "P")))
    import_files(spark, [path], store)
    version, table = store.version(), rows(store, STUMPAGE, *STUMPAGE.names, "ID")
    assert import_files(spark, [path], store).processed == {"stumpage": 2}
    assert rows(store, STUMPAGE, *STUMPAGE.names, "ID") == table
    assert store.version() == version  # nothing differed, nothing was written


def factor_file(write, name, *lines):
    return write(name, "factor_id,TALLY_DESTINATION_CODE,DESTINATION_CODE,SPECIES_CODE,TAX_RATE,EFFECTIVE_DATE,EXPIRY_DATE,note\n" + "\n".join(lines))


def test_factor_is_lenient_and_counts_changes(spark, store, write):
    lines = ["1,T,D,S,x,1042026,2042026,n", "1,T,D,S,1e1,1042026,2042026,n", "1,T,D,S,10,1042026,2042026,n"]
    path = factor_file(write, "f.csv", *lines, "bad,T,D,S,,1042026,2042026")
    assert import_files(spark, [path], store).processed == {"factor": 3}
    assert rows(store, FACTOR, "FACTOR_ID", "TAX_RATE", "GRADE", "DESTINATION_SHARE", "ID") == {
        (1, 10.0, "", 0.0, 1),
        (0, 0.0, "", 0.0, 2),
    }
    path = factor_file(write, "g.csv", "1,T,D,S,10,1042026,2042026", "0,T,D,S,0,1042026,2042026")
    assert import_files(spark, [path], store).processed == {"factor": 0}
    path = factor_file(write, "h.csv", "1,T,D,S,11,1042026,2042026", "5,T,D,S,0,1042026,2042026")
    assert import_files(spark, [path], store).processed == {"factor": 2}
    assert rows(store, FACTOR, "FACTOR_ID", "TAX_RATE", "ID") == {(1, 11.0, 1), (0, 0.0, 2), (5, 0.0, 3)}


def test_factor_with_a_bad_date_is_a_violation(spark, store, write):
    path = factor_file(write, "f.csv", "1,T,D,S,1,99992026,2042026")
    with pytest.raises(ImportAborted, match="EFFECTIVE_DATE not_null"):
        import_files(spark, [path], store)


def test_renewal_codes_and_insert_only_column(spark, store, write):
    path = write("r.csv", text(RENEWAL_HEADER, renewal(1, "0350", "p", 1), renewal(1, "350", "q", 2)))
    assert import_files(spark, [path], store).processed == {"renewal": 2}
    columns = ("RATE_ID", "MANAGEMENT_UNIT_CODE", "SPECIES_GROUP_CODE", "RATE", "ID")
    assert rows(store, RENEWAL, *columns) == {(1, "350", "p", 2.0, 1)}
    path = write("r2.csv", text(RENEWAL_HEADER, renewal(1, "00350", "z", 3)))
    import_files(spark, [path], store)
    assert rows(store, RENEWAL, *columns) == {(1, "350", "p", 3.0, 1)}


def test_stored_duplicates_are_all_updated_and_count_once(spark, store, write):
    base = [(*["x"] * 1, 1, "P", "old", "G", "g", "R", "r", 1.0, dt.date(2020, 1, 1), dt.date(2020, 1, 1), i) for i in (1, 2)]
    store.load(STUMPAGE, spark.createDataFrame(base, STUMPAGE.schema))
    path = write("s.csv", text(STUMPAGE_HEADER, stumpage(1, "P", "new")))
    assert import_files(spark, [path], store).processed == {"stumpage": 1}
    assert rows(store, STUMPAGE, "PRODUCT_TYPE_NAME", "ID") == {("new", 1), ("new", 2)}


def test_abort_leaves_everything_as_it_was(spark, store, write):
    good = write("a.csv", text(STUMPAGE_HEADER, stumpage(1, "P")))
    import_files(spark, [good], store)
    before = store.version()
    bad = write("b.csv", text(STUMPAGE_HEADER, "", stumpage(2, "P"), "", stumpage("x", "P", rate="1e3")))
    other = write("r.csv", text(RENEWAL_HEADER, renewal(1, 5)))
    with pytest.raises(ImportAborted, match=r"b.csv line 5: RATE_ID conversion 'x'"):
        import_files(spark, [other, bad], store)
    assert store.version() == before
    log = read_import_log(spark, f"{store.root}/_log").where("level = 'ERROR'").collect()
    assert [(r.feed, r.row_count, r.error_count, r.processed) for r in log] == [("stumpage", 2, 1, 0)]


def test_skip_sets_bad_rows_and_files_aside(spark, store, write):
    long_name = "n" * 51
    bad = write(
        "b.csv",
        text(STUMPAGE_HEADER, stumpage(1, "P"), stumpage("x", "P", rate="1e3"), "S,3,P", stumpage(4, "P", long_name), stumpage(5, "P", start="31022026"), end="\r\n"),
    )
    unknown = write("u.csv", "a,b\n1,2\n")
    empty = write("e.csv", "")
    result = import_files(spark, [bad, unknown, empty], store, policy="skip")
    assert result.processed == {"stumpage": 1} and result.error_count == 4
    assert rows(store, STUMPAGE, "RATE_ID") == {(1,)}
    got = {(r.line_no, r.column, r.reason, r.value) for r in result.rejects.collect()}
    short = [c for c in STUMPAGE.names[3:] if c not in ("RATE",)]
    assert got == {
        (3, "RATE_ID", "conversion", "x"),
        (3, "RATE", "conversion", "1e3"),
        (4, "RATE", "conversion", None),
        *[(4, c, "not_null", None) for c in short],
        (5, "PRODUCT_TYPE_NAME", "length", long_name),
        (6, "EFFECTIVE_DATE", "not_null", "31022026"),
    }
    files = {r.file.rsplit("/", 1)[1]: (r.level, r.row_count, r.processed, r.error_count) for r in result.files.collect()}
    assert files == {
        "b.csv": ("WARNING", 5, 1, 4),
        "u.csv": ("ERROR", 0, 0, 0),
        "e.csv": ("ERROR", 0, 0, 0),
    }


def test_missing_column_of_a_strict_feed_is_a_problem_and_header_only_is_not(spark, store, write):
    path = write("h.csv", STUMPAGE_HEADER + "\n")
    result = import_files(spark, [path], store)
    assert result.processed == {"stumpage": 0}
    assert [r.level for r in result.files.collect()] == ["WARNING"]
    path = write("m.csv", STUMPAGE_HEADER.replace(",RATE,", ",") + "\nS,1,P,N,G,g,R,r,1042026,1042026\n")
    with pytest.raises(ImportAborted, match="lacks columns: RATE"):
        import_files(spark, [path], store)


def test_import_without_a_good_row_changes_nothing(spark, store, write):
    import_files(spark, [write("a.csv", text(STUMPAGE_HEADER, stumpage(1, "P")))], store)
    before = store.version()
    bad = write("b.csv", text(STUMPAGE_HEADER, stumpage("x", "P")))
    only_header = write("c.csv", STUMPAGE_HEADER)
    result = import_files(spark, [bad, only_header], store, policy="skip")
    assert (result.processed, result.error_count) == ({"stumpage": 0}, 1)
    assert store.version() == before


def test_a_file_named_twice_is_read_once(spark, store, write, tmp_path):
    path = write("a.csv", text(STUMPAGE_HEADER, stumpage(1, "P")))
    result = import_files(spark, [path, str(tmp_path / "in"), path], store)
    assert result.processed == {"stumpage": 1}


def test_columns_are_found_by_each_files_own_header(spark, store, write):
    names = list(reversed(STUMPAGE.names))
    values = dict(zip(STUMPAGE.names, "S,2,P,N,G,g,R,r,2,1042026,1042026".split(",")))
    a = write("a.csv", text(STUMPAGE_HEADER, stumpage(1, "P")))
    b = write("b.csv", text(",".join(n.lower() for n in names), ",".join(values[n] for n in names)))
    import_files(spark, [a, b], store)
    assert rows(store, STUMPAGE, "RATE_ID", "RATE") == {(1, 1.5), (2, 2.0)}


def test_a_header_line_further_down_is_a_row(spark, store, write):
    path = write("a.csv", text(STUMPAGE_HEADER, stumpage(1, "P"), STUMPAGE_HEADER))
    with pytest.raises(ImportAborted, match="line 3: RATE_ID conversion 'RATE_ID'"):
        import_files(spark, [path], store)


def test_second_writer_of_a_version_fails(spark, store):
    store.create_tables()
    store.publish(Version(number=2))
    with pytest.raises(Conflict):
        store.publish(Version(number=2))
    assert store.read(FACTOR).count() == 0
    assert store.read(FACTOR).schema == FACTOR.schema


def test_stream_imports_every_file_once(spark, store, write, tmp_path):
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    write("a.csv", text(STUMPAGE_HEADER, stumpage(1, "P"), stumpage(2, "P")))
    import_stream(spark, landing, store, checkpoint)
    first = store.version()
    import_stream(spark, landing, store, checkpoint)
    assert store.version() == first
    write("b c.csv", text(STUMPAGE_HEADER, stumpage(2, "P", rate="9"), stumpage(3, "P")))
    import_stream(spark, landing, store, checkpoint)
    assert rows(store, STUMPAGE, "RATE_ID", "RATE", "ID") == {(1, 1.5, 1), (2, 9.0, 2), (3, 1.5, 3)}
    # A batch that is replayed is not imported again.
    ((stream, (number, digest)),) = store.version().tags.items()
    again = import_files(spark, [landing], store, tag=(stream, number, digest))
    assert again.processed == {} and store.version().number == again.version
    with pytest.raises(ValueError, match="with other files"):
        import_files(spark, [landing], store, tag=(stream, number, "other"))


def test_stream_of_two_folders_and_a_fresh_checkpoint(spark, store, write, tmp_path):
    for k in (1, 2):
        write(f"land{k}/a.csv", text(STUMPAGE_HEADER, stumpage(k, "P")))
        import_stream(spark, str(tmp_path / "in" / f"land{k}"), store, str(tmp_path / f"check{k}"))
    assert rows(store, STUMPAGE, "RATE_ID") == {(1,), (2,)}
    write("land1/b.csv", text(STUMPAGE_HEADER, stumpage(3, "P")))
    import_stream(spark, str(tmp_path / "in" / "land1"), store, str(tmp_path / "fresh"))
    assert rows(store, STUMPAGE, "RATE_ID", "ID") == {(1, 1), (2, 2), (3, 3)}


def test_stream_takes_files_of_any_age(spark, store, write, tmp_path):
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    write("a.csv", text(STUMPAGE_HEADER, stumpage(1, "P")))
    import_stream(spark, landing, store, checkpoint)
    old = write("b[1].csv", text(STUMPAGE_HEADER, stumpage(2, "P")))
    os.utime(old, (1_500_000_000, 1_500_000_000))
    import_stream(spark, landing, store, checkpoint)
    assert rows(store, STUMPAGE, "RATE_ID") == {(1,), (2,)}


def test_a_bad_file_does_not_stop_its_folder(spark, store, write, tmp_path):
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    bad = write("a.csv", text(STUMPAGE_HEADER, stumpage(1, "P"), stumpage("x", "P"), stumpage(2, "P")))
    unknown = write("b.csv", "a,b\n1,2\n")
    write("c.csv", text(STUMPAGE_HEADER, stumpage(3, "P")))
    import_stream(spark, landing, store, checkpoint)
    assert rows(store, STUMPAGE, "RATE_ID") == {(3,)}  # nothing of a bad file
    log = {r.file.rsplit("/", 1)[1]: (r.level, r.row_count, r.processed, r.error_count) for r in read_import_log(spark, f"{store.root}/_log").collect()}
    assert log == {"a.csv": ("ERROR", 3, 0, 1), "b.csv": ("ERROR", 0, 0, 0), "c.csv": ("SUCCESS", 1, 1, 0)}
    write("d.csv", text(STUMPAGE_HEADER, stumpage(4, "P"), stumpage(1, "P", rate="7")))
    import_stream(spark, landing, store, checkpoint)
    assert rows(store, STUMPAGE, "RATE_ID", "RATE") == {(3, 1.5), (4, 1.5), (1, 7.0)}
    assert {p.rsplit("/", 1)[1] for p in store.version().aside} == {"a.csv", "b.csv"}
    # Mended, it is taken by the next call, and counts as the latest.
    write("a.csv", text(STUMPAGE_HEADER, stumpage(1, "P"), stumpage(22, "P")))
    version = store.version().number
    import_stream(spark, landing, store, checkpoint)
    assert rows(store, STUMPAGE, "RATE_ID", "RATE") == {(3, 1.5), (4, 1.5), (1, 1.5), (22, 1.5)}
    assert store.version().number == version + 1 and {p.rsplit("/", 1)[1] for p in store.version().aside} == {"b.csv"}
    # Unchanged, it is not read again.
    import_stream(spark, landing, store, checkpoint)
    assert store.version().number == version + 1
    os.remove(unknown)
    import_stream(spark, landing, store, checkpoint)
    assert bad and store.version().number == version + 1


def test_one_outcome_for_each_file(spark, store, write):
    files = [write(f"{k}.csv", text(STUMPAGE_HEADER, stumpage(1, "P", rate=str(k)), *([stumpage("x", "P")] if k % 2 else []))) for k in range(4)]
    result = import_files(spark, files, store, policy="files")
    assert {p.rsplit("/", 1)[1] for p in result.aside} == {"1.csv", "3.csv"} and result.error_count == 2
    assert rows(store, STUMPAGE, "RATE_ID", "RATE") == {(1, 2.0)} and result.processed == {"stumpage": 2}
    assert {r.value for r in result.rejects.collect()} == {"x"}
    # A later import of the file by another policy takes it off the list.
    import_files(spark, files[1:2], store, policy="skip")
    assert {p.rsplit("/", 1)[1] for p in store.version().aside} == {"3.csv"}
    assert rows(store, STUMPAGE, "RATE_ID", "RATE") == {(1, 1.0)}


def test_names_that_look_like_patterns(spark, store, write):
    path = write("a[1].csv", text(STUMPAGE_HEADER, stumpage(1, "P")))
    write("a1.csv", text(STUMPAGE_HEADER, stumpage(2, "P")))
    result = import_files(spark, [path], store)
    assert result.processed == {"stumpage": 1} and rows(store, STUMPAGE, "RATE_ID") == {(1,)}
    assert [f.path.rsplit("/", 1)[1] for f in list_files(spark, [path.replace("a[1]", "a?")])] == ["a1.csv"]
    import_files(spark, [path.rsplit("/", 1)[0]], store)
    assert rows(store, STUMPAGE, "RATE_ID") == {(1,), (2,)}


def test_a_hidden_name_is_an_error_that_is_logged(spark, store, write):
    seen = write("a.csv", text(STUMPAGE_HEADER, stumpage(1, "P")))
    hidden = write("_b.csv", text(STUMPAGE_HEADER, stumpage(2, "P")))
    with pytest.raises(ValueError, match="_b.csv"):
        import_files(spark, [seen, hidden], store)
    log = read_import_log(spark, f"{store.root}/_log").collect()
    assert {r.level for r in log} == {"ERROR"} and store.version().number == 0


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("split", [1000, 1 << 27])
def test_a_header_after_very_many_blank_lines(spark, store, write, end, split):
    """More blank lines than any beginning of a file would hold, or ending near a split."""
    paths = [write(f"{n}.csv", end * n + text(STUMPAGE_HEADER, *[stumpage(n * 10 + i, "P") for i in range(3)], end=end)) for n in (0, 997, 40_000)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split if split > 1000 else 20_011))
    try:
        result = import_files(spark, paths, store)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert result.processed == {"stumpage": 9} and {r.row_count for r in result.files.collect()} == {3}


def test_headers_of_any_shape(spark, write):
    a = write("a.csv", " \n" * 40 + "x,y\r1,2\r")
    b = write("b.csv", b"\xef\xbb\xbf" + b"x,y\n3,4")
    c = write("c.csv", gzip.compress(b"q\n5\n"))
    os.rename(c, c + ".gz")
    d = write("d.csv", "z\n")
    tables = read_delimited(spark, [a, b, c + ".gz", d], new_scratch(spark, "t"))
    assert {t.names: sorted(tuple(r) for r in t.df.select(*t.names).collect()) for t in tables} == {
        ("x", "y"): [("1", "2"), ("3", "4")],
        ("q",): [("5",)],
        ("z",): [],
    }


def test_raw_tables_read_only_their_folder(spark, write):
    paths = [write(f"{i}.csv", f"k{i}\n{i}\n") for i in range(30)]
    tables = read_delimited(spark, paths, new_scratch(spark, "t"))
    for t in tables:
        assert [r[0] for r in t.df.select(*t.names).collect()] == [t.names[0][1:]]
    plan = tables[7].df._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_kind" in plan and "Join" not in plan


@pytest.mark.parametrize("encoding, mark", [("utf-16-le", b"\xff\xfe"), ("utf-16-be", b"\xfe\xff")])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_utf16_like_its_utf8_twin(spark, tmp_path, write, encoding, mark, end):
    names = ["Épinette ਅ", "小麦, 米", "😀"]
    body = end * 3 + text(STUMPAGE_HEADER, *[stumpage(i, "P", names[i % 3]) for i in range(300)], "", stumpage("x", "P"), end=end)
    found = []
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        for kind, raw in (("utf8", body.encode()), ("utf16", mark + body.encode(encoding))):
            store = TableStore(spark, str(tmp_path / kind))
            plain = write(f"{kind}/plain.csv", text(STUMPAGE_HEADER, stumpage(9000, "Q")))
            result = import_files(spark, [write(f"{kind}/in.csv", raw), plain], store, policy="skip")
            bad = [(r.line_no, r.column, r.value) for r in result.rejects.collect()]
            found.append((result.processed, bad, rows(store, STUMPAGE, *STUMPAGE.names, "ID")))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found[0] == found[1]
    assert found[0][0] == {"stumpage": 301} and found[0][1] == [(306, "RATE_ID", "x")]


def test_utf16_that_cannot_be_split_is_named(spark, store, write):
    # U+0A15 before U+0100: the bytes of a line feed across two characters.
    path = write("a.csv", b"\xff\xfe" + text(STUMPAGE_HEADER, stumpage(1, "P", "\u15a0\u0a00")).encode("utf-16-le"))
    odd = write("b.csv", b"\xff\xfe" + text(STUMPAGE_HEADER, stumpage(2, "P", "\u0a15\u0100")).encode("utf-16-le"))
    result = import_files(spark, [path, odd], store, policy="skip")
    assert result.processed == {"stumpage": 1}
    assert {r.message for r in result.files.where("level = 'ERROR'").collect()} == {lines.UTF16_SPLIT}


def test_an_import_that_fails_is_logged_and_leaves_nothing(spark, store, write, monkeypatch):
    path = write("a.csv", text(STUMPAGE_HEADER, stumpage(1, "P")))

    def broken(version):
        raise OSError("no space")

    monkeypatch.setattr(store, "publish", broken)
    with pytest.raises(OSError):
        import_files(spark, [path], store)
    (entry,) = read_import_log(spark, f"{store.root}/_log").collect()
    assert (entry.level, entry.file.rsplit("/", 1)[1]) == ("ERROR", "a.csv") and "no space" in entry.message
    assert store.version().number == 0
    assert not glob.glob(f"{store.root}/**/*.parquet", recursive=True) or all(
        "/_log/" in f or "/_headers/" in f for f in glob.glob(f"{store.root}/**/*.parquet", recursive=True)
    )


def test_the_log_survives_a_stop_after_publishing(spark, store, write, monkeypatch):
    path = write("a.csv", text(STUMPAGE_HEADER, stumpage(1, "P")))
    settle = store.settle_log
    calls = []

    def stop(run):
        calls.append(run)
        if len(calls) == 2:
            raise KeyboardInterrupt
        settle(run)

    monkeypatch.setattr(store, "settle_log", stop)
    with pytest.raises(KeyboardInterrupt):
        import_files(spark, [path], store)
    assert rows(store, STUMPAGE, "RATE_ID") == {(1,)}
    monkeypatch.undo()
    import_files(spark, [path], store)
    log = read_import_log(spark, f"{store.root}/_log").collect()
    assert [r.level for r in log] == ["SUCCESS"] * 2 and len({r.run for r in log}) == 2


def test_one_writer_wins(spark, tmp_path):
    for k in range(20):
        store = TableStore(spark, str(tmp_path / f"s{k}"))
        gate, wins = threading.Barrier(2), []

        def publish(me):
            gate.wait()
            try:
                store.publish(Version(number=1, run=me))
                wins.append(me)
            except Conflict:
                pass

        threads = [threading.Thread(target=publish, args=(m,)) for m in "ab"]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        assert len(wins) == 1 and store.version().run == wins[0]


def test_header_report(spark, store, write):
    lacking = write("a.csv", STUMPAGE_HEADER.replace(",RATE,", ",") + ",EXTRA\nS,1,P,N,G,g,R,r,1042026,1042026,z\n")
    good = write("b.csv", text(STUMPAGE_HEADER, stumpage(2, "P")))
    with pytest.raises(ImportAborted, match="lacks columns: RATE"):
        import_files(spark, [lacking, good], store)
    result = import_files(spark, [lacking, good], store, policy="skip")
    assert result.processed == {"stumpage": 1}
    odd = result.headers.where("status <> 'matched'").collect()
    assert {(r.file.rsplit("/", 1)[1], r.column, r.status) for r in odd} == {("a.csv", "RATE", "missing"), ("a.csv", "EXTRA", "extra")}
    assert result.headers.where("status = 'matched'").count() == 2 * len(STUMPAGE.names) - 1
    assert {r.level for r in result.files.where("file LIKE '%a.csv'").collect()} == {"ERROR"}


def test_collated_keys_in_a_store(spark, tmp_path, write):
    import dataclasses

    spec = dataclasses.replace(STUMPAGE, key_collation="UTF8_LCASE_RTRIM")
    store = TableStore(spark, str(tmp_path / "store"), (spec,))
    a = write("a.csv", text(STUMPAGE_HEADER, stumpage(1, "Pine"), stumpage(1, "PINE", rate="2")))
    b = write("b.csv", text(STUMPAGE_HEADER, stumpage(1, "pine", rate="3")))
    import_files(spark, [a], store)
    import_files(spark, [b], store)
    assert rows(store, spec, "PRODUCT_TYPE_CODE", "RATE", "ID") == {("Pine", 3.0, 1)}


def test_a_table_refuses_what_breaks_its_constraints(spark, store):
    good = ("S", 1, "P", "N", "G", "g", "R", "r", 1.0, dt.date(2020, 1, 1), dt.date(2020, 1, 1), 1)
    names = [f.name for f in STUMPAGE.schema]
    assert not any(f.nullable for f in STUMPAGE.schema)
    assert [f.name for f in FACTOR.schema if f.nullable] == ["DESTINATION_SHARE"]
    nullable = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STUMPAGE.schema)
    for column, value, message in (("RATE", None, "RATE must not be NULL"), ("ID", None, "ID must not be NULL"), ("TYPE", "t" * 51, "TYPE has more than 50")):
        row = dict(zip(names, good)) | {column: value}
        with pytest.raises(Exception, match=message):
            store.load(STUMPAGE, spark.createDataFrame([tuple(row.values())], nullable))
    assert store.version().number == 0
    store.load(STUMPAGE, spark.createDataFrame([good], nullable))
    assert rows(store, STUMPAGE, "RATE_ID", "ID") == {(1, 1)}


def test_an_added_column_has_its_default_in_old_rows(spark, store, write):
    import_files(spark, [write("a.csv", text(STUMPAGE_HEADER, stumpage(1, "P"), stumpage(2, "P")))], store)
    wider = TableStore(spark, store.root, (WIDER,))
    assert rows(wider, WIDER, "RATE_ID", "REGION", "LEVEL") == {(1, "unknown", 0), (2, "unknown", 0)}
    # Also where a filter on the column reaches the scan, and after a merge that rewrites a file.
    assert wider.read(WIDER).where("REGION = 'unknown' AND LEVEL = 0").count() == 2
    path = write("b.csv", text(f"{STUMPAGE_HEADER},LEVEL,REGION", f"{stumpage(2, 'P')},7,north", f"{stumpage(3, 'P')},8,south"))
    assert import_files(spark, [path], wider).processed == {"stumpage": 2}
    assert rows(wider, WIDER, "RATE_ID", "REGION", "LEVEL", "ID") == {(1, "unknown", 0, 1), (2, "north", 7, 2), (3, "south", 8, 3)}


def test_defaults_that_replace_a_text_are_reported(spark, store, write):
    a = factor_file(write, "a.csv", "x,T,D,S,1,1042026,2042026", "", "y,T,D,S,,1042026,2042026", "0,T,D,S,0.0,1042026,2042026")
    b = factor_file(write, "b.csv", "1,T,D,S, 0 ,1042026,2042026", "2,T,D,S,1d,1042026,2042026", "z,T,D,S,1,99999999,2042026")
    result = import_files(spark, [a, b], store, policy="skip")
    found = {(r.file.rsplit("/", 1)[1], r.line_no, r.column, r.value) for r in result.defaulted.collect()}
    assert found == {("a.csv", 2, "FACTOR_ID", "x"), ("a.csv", 4, "FACTOR_ID", "y"), ("b.csv", 3, "TAX_RATE", "1d")}
    assert {r.file.rsplit("/", 1)[1]: r.defaulted for r in result.files.collect()} == {"a.csv": 2, "b.csv": 1}
    assert import_files(spark, [factor_file(write, "c.csv", "1,T,D,S,0,1042026,2042026")], store).defaulted is None
    aside = import_files(spark, [b], store, policy="files")
    assert aside.defaulted is None or aside.defaulted.count() == 0


def test_columns_that_no_file_has_are_not_staged_or_dealt(spark, store, write, monkeypatch):
    staged = {}
    monkeypatch.setattr(importer, "written_around", lambda df, path, constant: staged.update({path: (df, constant)}) or written_around(df, path, constant))
    first = factor_file(write, "a.csv", *[f"{k},A,B,C,{n},1042026,2042026" for n, k in enumerate((1, 2, 1, 4))])
    import_files(spark, [first], store)
    (frame, constant), = staged.values()
    assert "GRADE" in constant and "FACTOR_ID" not in constant and set(constant) < set(FACTOR.names)
    assert frame.columns[3:-2] == list(FACTOR.names)
    got = {r.FACTOR_ID: r for r in store.read(FACTOR).collect()}
    assert [got[k].ID for k in (1, 2, 4)] == [1, 2, 3] and got[1].GRADE == "" and got[1].DESTINATION_SHARE == 0.0
    second = write("b.csv", text("factor_id,tally_destination_code,destination_code,species_code,effective_date,expiry_date,grade", "2,A,B,C,01042026,01042027,X", "9,A,B,C,01042026,01042027,Y"))
    assert import_files(spark, [second], store).processed == {"factor": 2}
    got = {r.FACTOR_ID: r for r in store.read(FACTOR).collect()}
    assert [(k, got[k].ID, got[k].GRADE) for k in (1, 2, 4, 9)] == [(1, 1, ""), (2, 2, "X"), (4, 3, ""), (9, 4, "Y")]


@pytest.mark.parametrize("few", [0, 200_000])
def test_a_second_import_is_the_same_with_hashes_and_with_bits(spark, store, write, monkeypatch, few):
    monkeypatch.setattr(merge, "BROADCAST_ROWS", few)
    lines_of = lambda ks, rate: [f"{k},A,B,C,{rate},1042026,2042026" for k in ks]
    import_files(spark, [factor_file(write, "a.csv", *lines_of(range(40), 1), *lines_of(range(0, 40, 8), 2))], store)
    again = [factor_file(write, "b.csv", *lines_of(range(30, 70), 3)), factor_file(write, "c.csv", *lines_of(range(32, 70, 4), 3))]
    result = import_files(spark, again, store)
    assert sorted(r.processed for r in result.files.collect()) == [0, 40]
    got = sorted((r.ID, r.FACTOR_ID, r.TAX_RATE) for r in store.read(FACTOR).collect())
    assert got == [(k + 1, k, 3.0 if k >= 30 else 2.0 if k % 8 == 0 else 1.0) for k in range(70)]
