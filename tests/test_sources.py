"""XML, CSV and ZIP sources, publish, guards."""
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from linkwright import session
from linkwright.sources import archive
from linkwright.sources.archive import load_zip_exports, module_name, write_zip_export
from linkwright.sources.csv import load_csv_dump
from linkwright.sources.guards import require_columns, require_path, require_rows
from linkwright.sources.publish import publish, read_current
from linkwright.sources.xml import load_xml_dump
from linkwright.plans.refresh import full_refresh
from conftest import rows


def _write(path, text, mode="w"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, mode) as fh:
        fh.write(text)


def test_xml_shapes(spark, tmp_path):
    d = tmp_path / "dump"
    _write(d / "a.xml", '<root name="firmen"><Row><a> x </a><b>001</b><c/></Row>'
                        '<Row><a>y</a><d>new</d><b>t<plz>1</plz></b></Row>'
                        '<Row><a>z</a><a>z2</a></Row><Row/></root>')
    _write(d / "b.xml", '<firmen><Row><a>w</a><e>e1</e></Row></firmen>')   # same table by tag
    _write(d / "items.xml", '<items><item><k>1</k></item><item><k>2</k><m>m</m></item></items>')
    _write(d / "empty.xml", '<leer><x><p/><q/></x><y/></leer>')              # not all children nested
    _write(d / "bare.xml", '<nothing/>')
    _write(d / "skip.txt", 'not xml')
    t = load_xml_dump(spark, str(d))
    assert set(t) == {"firmen", "items", "leer", "nothing"}
    f = {r["a"]: r for r in t["firmen"].collect()}
    assert f[" x "]["b"] == "001" and f[" x "]["c"] is None          # spaces, leading zeros, empty
    assert f["y"]["d"] == "new" and f["y"]["b"] == "t"
    assert f["z"]["d"] is None                                          # evolving schema
    assert f["w"]["e"] == "e1"
    assert None in f                                                    # row without children
    assert rows(t["items"], "k", "m") == [("1", None), ("2", "m")]
    assert t["leer"].columns == ["p", "q"] and t["leer"].count() == 0
    assert t["nothing"].columns == ["id"] and t["nothing"].count() == 0


def test_csv_dump_na_tokens(spark, tmp_path):
    d = tmp_path / "csv"
    _write(d / "Accounts.csv", 'Id,Name,Note\n1,NA,"multi\nline"\n2,Nil,\n3,"a ""q""",null\n')
    _write(d / "ignore.txt", "x")
    t = load_csv_dump(spark, str(d))
    assert list(t) == ["Accounts"]
    assert rows(t["Accounts"]) == [("1", None, "multi\nline"), ("2", "Nil", None),
                                   ("3", 'a "q"', None)]


def test_zip_exports(spark, tmp_path):
    d = tmp_path / "landing"
    d.mkdir()
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("Deals.csv", "Id,Stage\n386758000060915086,Won\n2,N/A\n")
    (d / "Deals_exportZoho.zip").write_bytes(buf.getvalue())
    t = load_zip_exports(spark, str(d))
    assert rows(t["Deals"]) == [("2", None), ("386758000060915086", "Won")]
    assert module_name("x/Deals_exportZoho-3.zip") == "Deals"


def test_publish_and_failed_refresh_keeps_current(spark, tmp_path):
    base = str(tmp_path / "tbl")
    publish(spark.createDataFrame([(1,)], "a int"), base, "v1")
    publish(spark.createDataFrame([(2,)], "a int"), base, "v2")
    assert rows(read_current(spark, base)) == [(2,)]
    with pytest.raises(ValueError):   # empty input: validation fails before any write
        full_refresh(spark.createDataFrame([], "a int"), base)
    with pytest.raises(ValueError):   # missing flag column
        full_refresh(spark.createDataFrame([(1,)], "a int"), base, ["via_angebote"])
    assert rows(read_current(spark, base)) == [(2,)]


def test_guards(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    require_columns(df, ["A"])
    with pytest.raises(ValueError):
        require_columns(df, ["b"])
    with pytest.raises(ValueError):
        require_rows(df.where("a > 5"))
    with pytest.raises(FileNotFoundError):
        require_path(spark, str(tmp_path / "missing"))


def test_xml_tag_case_merges(spark, tmp_path):
    """§2.13 item 16: tags differing only in case are one column, across rows and files."""
    d = tmp_path / "case"
    _write(d / "a.xml", '<root name="t"><Row><Name>x</Name><k>1</k></Row>'
                        '<Row><name>y</name><k>2</k></Row></root>')
    _write(d / "b.xml", '<root name="t"><Row><NAME>z</NAME><k>3</k></Row></root>')
    t = load_xml_dump(spark, str(d))["t"]
    assert [c.lower() for c in t.columns] == ["name", "k"]
    assert rows(t) == [("x", "1"), ("y", "2"), ("z", "3")]


def test_save_dump_overwrite_is_idempotent(spark, tmp_path):
    """Writing a loaded dump twice keeps one copy; append is opt-in."""
    from linkwright.sources.xml import save_dump
    d = tmp_path / "dump"
    _write(d / "a.xml", '<root name="firmen"><Row><a>1</a></Row><Row><a>2</a></Row></root>')
    tables = load_xml_dump(spark, str(d))
    target = str(tmp_path / "warehouse")
    save_dump(tables, target)
    save_dump(tables, target)
    assert spark.read.parquet(f"{target}/firmen").count() == 2
    save_dump(tables, target, mode="append")
    assert spark.read.parquet(f"{target}/firmen").count() == 4


def test_malformed_xml_raises(spark, tmp_path):
    _write(tmp_path / "bad" / "a.xml", '<root name="t"><Row><a>1</a></Row><Row><a>2</b></Row><Row><a>3</a></Row></root>')
    with pytest.raises(Exception):
        load_xml_dump(spark, str(tmp_path / "bad"))["t"].collect()


def test_rows_inside_rows_are_rows(spark, tmp_path):
    _write(tmp_path / "d" / "a.xml", '<root name="t"><Row><a>1</a><x><Row><a>2</a></Row><Row><a>3</a><Row><a>4</a></Row></Row></x>'
                                     '</Row><Row><a>5</a></Row></root>')
    t = load_xml_dump(spark, str(tmp_path / "d"))["t"]
    assert sorted(r.a for r in t.collect()) == ["1", "2", "3", "4", "5"]


def test_csv_rows_longer_than_the_header_raise(spark, tmp_path):
    _write(tmp_path / "c" / "a.csv", "x,y\n1,2\n3\n")
    assert rows(load_csv_dump(spark, str(tmp_path / "c"))["a"]) == [("1", "2"), ("3", None)]
    _write(tmp_path / "e" / "a.csv", "x,y\n1,2\n3,4,5\n")
    with pytest.raises(Exception, match="more fields"):
        load_csv_dump(spark, str(tmp_path / "e"))["a"].collect()


def _zip(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as zf:
        for name, text in members.items():
            zf.writestr(name, text)


def test_zip_members_with_different_headers(spark, tmp_path):
    d = tmp_path / "z"
    _zip(d / "Deals_exportZoho.zip", {"a.csv": "Id,Stage\n1,Won\n", "b.csv": "Owner,Id\nme,2\nyou,3\n"})
    _zip(d / "Leads_exportZoho.zip", {"a.csv": "Id,Name\n"})
    t = load_zip_exports(spark, str(d))
    assert rows(t["Deals"], "Id", "Stage", "Owner") == [("1", "Won", None), ("2", None, "me"), ("3", None, "you")]
    assert t["Leads"].columns == ["Id", "Name"] and t["Leads"].count() == 0


@pytest.mark.parametrize("members", [{"a.csv": "x\n1,2\n"}, {"a.txt": "x"}])
def test_zip_with_long_rows_or_other_members_raises(spark, tmp_path, members):
    _zip(tmp_path / "z" / "Deals_exportZoho.zip", members)
    with pytest.raises(Exception, match="header has|no CSV"):
        load_zip_exports(spark, str(tmp_path / "z"))


def test_save_refuses_an_existing_target(spark, tmp_path):
    from linkwright.sources.csv import save_tables
    t = {"a": spark.createDataFrame([(1,)], "x int")}
    save_tables(t, str(tmp_path / "w"))
    with pytest.raises(Exception, match="(?i)exists"):
        save_tables(t, str(tmp_path / "w"))
    assert rows(spark.read.parquet(str(tmp_path / "w" / "a"))) == [(1,)]


def test_child_tags_that_also_occur_deeper(spark, tmp_path):
    """Only direct children of the root are rows, whatever their tags; nothing inside them is."""
    (tmp_path / "t.xml").write_text("<root><a><id>1</id><b>inner</b></a><b><id>2</id><c>z</c><c>again</c></b>"
                                    "<a><id/><c> <b><id>9</id></b></c></a></root>")
    (tmp_path / "u.xml").write_text("<root><a><id>3</id><d>plain</d></a></root>")
    got = load_xml_dump(spark, str(tmp_path))["root"]
    assert rows(got, "id", "b", "c", "d") == rows(spark.createDataFrame(
        [("1", "inner", None, None), ("2", None, "z", None), (None, None, None, None), ("3", None, None, "plain")],
        "id string, b string, c string, d string"))


def test_zip_export_into_the_shared_checkpoint_folder_of_a_cluster(spark, monkeypatch):
    """A cluster whose checkpoint folder has a file: URI writes there, and to no other local folder."""
    for module in (session, archive):
        monkeypatch.setattr(module, "is_local", lambda _: False, raising=False)
    df = spark.createDataFrame([("1", "Won"), ("2", None)], "Id string, Stage string")
    folder = session.scratch_path(spark, "zip_shared")
    assert write_zip_export(df, folder, "Deals") > 0
    assert rows(load_zip_exports(spark, folder)["Deals"]) == [("1", "Won"), ("2", None)]
    base = session.ensure_checkpoint_dir(spark)
    for other in ("/tmp/elsewhere", "file:/tmp/elsewhere", f"{base}-2/x", f"{base}/../x"):
        with pytest.raises(ValueError, match="folder of one machine"):
            write_zip_export(df, other, "Deals")


def test_zip_modules_in_the_shared_checkpoint_folder_of_a_cluster(spark, monkeypatch):
    """Two modules, archives with different headers, one without rows."""
    for module in (session, archive):
        monkeypatch.setattr(module, "is_local", lambda _: False, raising=False)
    folder = session.scratch_path(spark, "zip_shared_modules")
    deals = spark.createDataFrame([("1", "Won"), ("2", None)], "Id string, Stage string")
    write_zip_export(deals, folder, "Deals")
    write_zip_export(deals.select("Id"), folder, "Deals")
    assert write_zip_export(deals.limit(0), folder, "Leads") > 0
    tables = load_zip_exports(spark, folder)
    assert rows(tables["Deals"].select("Id", "Stage")) == [("1", "Won"), ("1", None), ("2", None), ("2", None)]
    assert tables["Leads"].columns == ["Id", "Stage"] and tables["Leads"].count() == 0
    with pytest.raises(ValueError, match="folder of one machine"):
        write_zip_export(deals, "file:/tmp/elsewhere", "Deals")


def test_a_module_without_rows_is_one_archive(spark, tmp_path):
    """However many partitions the session makes of one row."""
    deals = spark.createDataFrame([("1", "Won")], "Id string, Stage string")
    assert write_zip_export(deals.where("Id = '2'"), str(tmp_path), "Leads") == 1
    assert len(list(tmp_path.glob("Leads_exportZoho-*.zip"))) == 1
    table = load_zip_exports(spark, str(tmp_path))["Leads"]
    assert table.columns == ["Id", "Stage"] and table.count() == 0
