"""The command line: properties files drive transfers."""

from tablemover.__main__ import main, read_properties
from tablemover.plans.registry import create_table, source_database
from tablemover.workspace import new_database, new_run_dir

SF = "/root/testdata/sf0.001"


def test_read_properties(tmp_path):
    p = tmp_path / "job.properties"
    p.write_text("# comment\n! also\na.b=1\nc : two words\nlong=x\\\n  y\nempty=\n"
                 "spaced value here\nesc\\=key=a\\tb\nuni=caf\\u00e9\npath=C:\\\\dir\n")
    assert read_properties(str(p)) == {"a.b": "1", "c": "two words", "long": "xy", "empty": "",
                                       "spaced": "value here", "esc=key": "a\tb", "uni": "café",
                                       "path": "C:\\dir"}


def test_run_extract_and_load_from_properties(spark, tmp_path, capsys):
    src = source_database(spark, SF, ["orders"])
    out = f"{new_run_dir(spark, 'cli')}/orders"
    job = tmp_path / "extract.properties"
    job.write_text(f"tablemover.warehouse=catalog\nsource.td.tablename={src}.orders\n"
                   f"target.hdfs.path={out}\nhdfs.fileformat=orcfile\n")
    assert main(["run", str(job)]) == 0
    assert spark.read.orc(out).count() == spark.table(f"{src}.orders").count()

    db = new_database(spark, "cli")
    create_table(spark, db, "orders", spark.table(f"{src}.orders").schema)
    job = tmp_path / "load.properties"
    job.write_text(f"tablemover.warehouse=catalog\nsource.hdfs.path={out}\nhdfs.fileformat=orcfile\n"
                   f"target.td.tablename={db}.orders\ntarget.td.table.replace=true\n"
                   "tablemover.key.columns=o_orderkey\n")
    assert main(["run", str(job)]) == 0
    assert "LoadReport" in capsys.readouterr().out
    assert spark.table(f"{db}.orders").count() == spark.table(f"{src}.orders").count()


def test_no_secrets_on_the_command_line():
    import pytest
    for command in ("encrypt", "decrypt"):
        with pytest.raises(SystemExit):
            main([command])


def test_mapping_from_properties(tmp_path, capsys):
    job = tmp_path / "job.properties"
    job.write_text("tablemover.warehouse=catalog\nsource.hdfs.path=/in\nhdfs.fileformat=orcfile\ntarget.td.tablename=db.t\n"
                   "tablemover.column.mapping=a=b,c=d\ntablemover.allow.unmatched=true\n")
    assert main(["check", str(job)]) == 0
    out = capsys.readouterr().out
    assert "column_mapping={'a': 'b', 'c': 'd'}" in out and "allow_unmatched=True" in out


def test_check_validates_without_spark(tmp_path, capsys):
    job = tmp_path / "job.properties"
    job.write_text("td.hostname=h\ntd.userid=u\ntd.encrypted.credential=abc\ntd.crypto.key.path=/k\n"
                   "source.hdfs.path=/in\nhdfs.fileformat=orcfile\ntarget.td.tablename=db.target\n")
    assert main(["check", str(job)]) == 0
    out = capsys.readouterr().out
    assert "direction=<Direction.LOAD_FILES" in out and "error_prefix='target'" in out
    assert "<encrypted>" not in out and "password='***********'" in out
    job.write_text("td.hostname=h\ntd.userid=u\nsource.hdfs.path=/in\n")
    import pytest
    with pytest.raises(ValueError, match="Password is required."):
        main(["check", str(job)])
