"""Files on disk: layouts, bad lines, encodings, archives, streams, exports."""

import zipfile
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from quartermark.operators.align import align_register
from quartermark.operators.normalize import consolidated, rows_per_source
from quartermark.operators.register import keyed_register
from quartermark.plans.consolidate import consolidate, write_bronze
from quartermark.schemas import STAGED_EXPENSES
from quartermark.sources import archives, tables
from quartermark.sources.delimited import (
    choose_separator, header_names, list_files, read_heads, read_register, read_staged,
)
from quartermark.sources.raw import scan
from quartermark.streaming.ingest import ingest, ingested


def put(path, text, encoding="latin-1"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


@pytest.fixture
def raw(tmp_path):
    root = tmp_path / "raw [1] dados"
    put(
        root / "2025" / "1T" / "semi colon.csv",
        "DATA;REG_ANS;DESCRICAO;VL_SALDO_FINAL\n"
        "2025-02-01;000001;Despesas com Eventos;1.234,56\n"
        "sem data;000002;Provisão de Eventos / Sinistros;1.500\n"
        "2025-02-01;000003;Receita;7,00\n"
        "2025-02-01;000004;Despesa com Evento;8,00;a mais\n"
        "2025-02-01;000005;Despesa com Evento\n"
        '2025-02-01;000006;"Despesa ""com evento""; Despesa com sinistro";9,00\n'
        "\n",
    )
    put(root / "2025" / "T2" / "COMMA.TXT", "VALOR,Cd_Operadora,NM_CONTA\n10.50,7,despesa com sinistro\n1.500,8,DESPESA COM SINISTROS\n")
    put(root / "2025" / "3" / "tab.txt", "COD\tDESC\tVL_MOVIMENTO\n9\tEvento / Sinistro\t-3\n")
    put(root / "2025" / "3" / "bar.csv", "reg_ans|desc|valor\n10|despesa com evento|x\n")
    put(root / "2025" / "3" / "notes.md", "VALOR;REG_ANS;DESC\n1;1;despesa com evento\n")
    put(root / "2025" / "3" / "no_value.csv", "REG_ANS;DESC\n1;despesa com evento\n")
    put(root / "2025" / "3" / "no_text.csv", "REG_ANS;VALOR\n1;2\n")
    put(root / "2025" / "3" / "no_key.csv", "DESC;VALOR\ndespesa com evento;2\n")
    put(root / "2025" / "3" / "qui+et ç.csv", "REG_ANS;DESC;VALOR\n1;Receita;2\n")
    put(root / "2025" / "3" / "empty.csv", " \n")
    put(root / "2025" / "3" / "nothing ç.CSV", "")
    put(root / "2025" / "3" / "nothing.md", "")
    put(root / "2025" / "_tmp" / "hidden.csv", "")
    return root


def path_of(root):
    return str(root).replace("[", "\\[").replace("]", "\\]")


def test_consolidate(spark, raw, rows):
    got = rows(consolidate(spark, path_of(raw)).drop("source_file"))
    assert got == sorted(
        [
            ("000001", "1T", 2025, D("1234.56"), False),
            ("000002", "1T", 2025, D("1500.00"), False),
            ("000005", "1T", 2025, None, True),
            ("000006", "1T", 2025, D("9.00"), False),
            ("7", "2T", 2025, D("10.50"), False),
            ("8", "2T", 2025, D("1.50"), False),
            ("9", "3T", 2025, D("-3.00"), True),
            ("10", "3T", 2025, None, True),
        ],
        key=repr,
    )


def test_bad_lines_stay_out_when_few_columns_are_selected(spark, raw):
    bronze = scan(spark, path_of(raw)).bronze()
    assert "000004" not in {r["reg_ans"] for r in bronze.select("reg_ans").collect()}


def test_accents_survive(spark, raw):
    bronze = scan(spark, path_of(raw)).bronze()
    assert bronze.filter(F.col("descricao") == "Provisão de Eventos / Sinistros").count() == 1


def test_skipped_files(spark, raw):
    bronze, files = write_bronze(spark, path_of(raw))
    reasons = {r["source_file"].rsplit("/", 1)[1]: r["motivo"] for r in files.skipped(bronze).collect()}
    assert reasons == {
        "no_value.csv": "no_value_column",
        "no_text.csv": "no_description_column",
        "no_key.csv": "no_key_column",
        "qui+et ç.csv": "no_keyword_match",
        "empty.csv": "unreadable",
        "nothing ç.CSV": "empty_file",
    }


def test_rows_per_source(spark, raw):
    counts = {r["source_file"].rsplit("/", 1)[1]: r["linhas"] for r in rows_per_source(consolidate(spark, path_of(raw))).collect()}
    assert counts == {"semi%20colon.csv": 4, "COMMA.TXT": 2, "tab.txt": 1, "bar.csv": 1}


def test_headers_that_differ_in_wording_share_a_read(spark, tmp_path, rows):
    put(tmp_path / "2025" / "1T" / "a.csv", "REG_ANS;DESC;VALOR\n1;despesa com evento;1\n")
    put(tmp_path / "2025" / "1T" / "b.csv", " cd_operadora ;NM_CONTA;SALDO_FINAL\n2;despesa com evento;2\n")
    put(tmp_path / "2025" / "1T" / "c.csv", "VALOR;REG_ANS;DESC\n3;3;despesa com evento\n")
    files = scan(spark, str(tmp_path))
    assert len(files.text.layouts) == 2
    assert rows(files.bronze().select("reg_ans", "valor")) == [("1", "1"), ("2", "2"), ("3", "3")]


def test_folder_without_usable_files(spark, tmp_path):
    put(tmp_path / "a.csv", "X;Y\n1;2\n")
    assert consolidate(spark, str(tmp_path)).count() == 0


def test_long_header_and_separators(spark, tmp_path):
    header = ";".join(f"COLUNA_{i}" for i in range(900))
    put(tmp_path / "wide.csv", header + "\n1\n")
    row = read_heads(list_files(spark, str(tmp_path))).first()
    assert len(header_names(row["header"], row["sep"])) == 900
    assert choose_separator("a,b\n1;2") == ";"
    assert choose_separator("a,b,c|d") == "," and choose_separator("alone") == ";"
    assert header_names("﻿A;B", ";") == ["A", "B"]


def test_separator_counts_the_whole_header(spark, tmp_path):
    names = ['"' + "a|" * 1100 + '"', *(f"COLUNA_{i}" for i in range(1500))]
    put(tmp_path / "wide.csv", ",".join(names) + "\n1\n")
    row = read_heads(list_files(spark, str(tmp_path))).first()
    assert row["sep"] == "," and len(header_names(row["header"], row["sep"])) == 1501
    # A semicolon beyond the sample does not win.
    assert choose_separator("a," * 1100 + "b;c") == ","


def test_register_file_order_decides(spark, tmp_path, rows):
    put(
        tmp_path / "cadop.csv",
        "REGISTRO_OPERADORA;CNPJ;Razao_Social;UF\n1;7;Saúde;SP\n000001;8;Outra;RJ\n2;9;Beta;SP;extra\n3;;Gama\n",
    )
    register = keyed_register(
        align_register(read_register(spark, str(tmp_path)), ["source_file", "block", "arrival"]), ["source_file", "block", "arrival"]
    )
    assert rows(register) == [(1, "7", "Saúde", None, "SP"), (3, None, "Gama", None, None)]


def test_archives(spark, tmp_path, rows):
    with zipfile.ZipFile(tmp_path / "1T.ZIP", "w") as archive:
        archive.writestr("sub/a.csv", "x;y\r\n1;ação\r\n2;b\r\n".encode("latin-1"))
        archive.writestr("b.csv", "x;y\n3;c")
        archive.writestr("vazio.csv", "")
    (tmp_path / "ruim.zip").write_bytes(b"not a zip")
    found, errors = archives.read_members(spark, str(tmp_path), str(tmp_path / "out"), ["x", "y"])
    assert rows(found.select("x", "y")) == [("1", "ação"), ("2", "b"), ("3", "c")]
    assert [r["archive"].rsplit("/", 1)[1] for r in errors.collect()] == ["ruim.zip"]


def test_workbooks_are_named_as_skipped(spark, tmp_path):
    put(tmp_path / "2025" / "1T" / "a b.XLSX", "a workbook")
    put(tmp_path / "2025" / "1T" / "a.csv", "REG_ANS;DESC;VALOR\n1;despesa com evento;1\n")
    files = scan(spark, str(tmp_path))
    bronze = files.bronze()
    assert bronze.count() == 1
    assert [(r["source_file"].rsplit("/", 1)[1], r["motivo"]) for r in files.skipped(bronze).collect()] == [("a b.XLSX", "workbook")]


def test_damaged_members_give_no_rows_and_are_reported(spark, tmp_path, rows):
    good = "a;b\n" + "".join(f"{i};{i * i}\n" for i in range(30_000))
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("bad.csv", good)
        archive.writestr("good.csv", "x;y\n1;2\n")
    data = bytearray((tmp_path / "a.zip").read_bytes())
    data[60_000:60_050] = b"\xff" * 50
    (tmp_path / "a.zip").write_bytes(data)
    found, errors = archives.read_members(spark, str(tmp_path), str(tmp_path / "out"), ["x", "y"])
    assert rows(found.select("x", "y")) == [("1", "2")]
    assert [r["member"] for r in errors.collect()] == ["bad.csv"]


def test_large_members_stay_in_order(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "big.zip", "w") as archive:
        archive.writestr("a.csv", "a;b\n" + "".join(f"{i};x\n" for i in range(50_001)))
    found, _ = archives.read_members(spark, str(tmp_path), str(tmp_path / "out"), ["n", "t"])
    assert found.count() == 50_001 and found.agg(F.max(F.col("n").cast("int"))).first()[0] == 50_000


def test_stream_takes_each_file_once(spark, tmp_path, rows):
    landing, target, offsets = (str(tmp_path / n) for n in ("landing", "target", "offsets"))
    first = "DATA;REG_ANS;DESC;VALOR\nx;1;despesa com evento;1,5\nx;2;despesa com evento;2.000\n"
    put(tmp_path / "landing" / "2025" / "1T" / "a.csv", first)
    ingest(spark, landing, target, offsets, per_batch=1).awaitTermination()
    once = rows(ingested(spark, target).drop("source_file"))
    assert once == [("1", "1T", 2025, D("1.50"), False), ("2", "1T", 2025, D("2000.00"), False)]

    put(tmp_path / "landing" / "2025" / "2T" / "b.csv", "REG_ANS,NM_CONTA,VALOR\n3,despesa com evento,4.5\n")
    put(tmp_path / "landing" / "2025" / "2T" / "c.csv", "REG_ANS;X\n3;4\n")
    ingest(spark, landing, target, offsets, per_batch=1).awaitTermination()
    assert rows(ingested(spark, target)) == rows(consolidate(spark, landing))

    ingest(spark, landing, target, offsets).awaitTermination()
    assert ingested(spark, target).count() == 3


def test_listing_reads_no_content(spark, tmp_path):
    """A listing that read file contents would fail for files above this limit."""
    landing, target = str(tmp_path / "landing"), str(tmp_path / "target")
    put(tmp_path / "landing" / "2025" / "1T" / "a.csv", "REG_ANS;DESC;VALOR\n1;despesa com evento;1\n")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 10)
    try:
        assert consolidate(spark, landing).count() == 1
        ingest(spark, landing, target, str(tmp_path / "offsets")).awaitTermination()
        assert ingested(spark, target).count() == 1
        with pytest.raises(Exception, match="(?i)length"):
            spark.read.format("binaryFile").load(f"{landing}/2025/1T").select("content").collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_another_checkpoint_overwrites_nothing(spark, tmp_path):
    target = str(tmp_path / "target")
    for number in ("11", "22"):
        landing = tmp_path / f"landing{number}"
        put(landing / "2025" / "1T" / "a.csv", f"REG_ANS;DESC;VALOR\n{number};despesa com evento;1\n")
        ingest(spark, str(landing), target, str(tmp_path / f"offsets{number}")).awaitTermination()
    assert sorted(r["REG_ANS"] for r in ingested(spark, target).collect()) == ["11", "22"]


def test_periods_without_rows_keep_their_types(spark, tmp_path):
    from quartermark.schemas import EXPENSE_TABLE

    path = str(tmp_path / "silver")
    row = [("1", None, None, D(1), False)]
    df = spark.createDataFrame(row, "REG_ANS string, Trimestre string, Ano int, ValorDespesas decimal(15,2), DespesasSuspeitas boolean")
    tables.append_expenses(df, path)
    back = tables.read_table(spark, path, EXPENSE_TABLE)
    assert dict(back.dtypes)["Ano"] == "int" and dict(back.dtypes)["Trimestre"] == "string"
    assert back.first()["Ano"] is None


def test_exports_read_back(spark, tmp_path, rows):
    df = spark.createDataFrame(
        [("a;b", 'c"d', D("1.50")), ("", None, None), ("x\\", "\\y", D("2.00"))], "p string, q string, v decimal(15,2)"
    )
    for compressed in (False, True):
        path = str(tmp_path / f"csv-{compressed}")
        tables.export_csv(df, path, compressed)
        back = read_staged(spark, path, df.select(*[F.col(c).cast("string") for c in df.columns]).schema)
        expected = df.fillna("", ["p", "q"])
        assert rows(back.withColumn("v", F.col("v").try_cast("decimal(15,2)"))) == rows(expected)


def test_append_adds_folders_per_period(spark, tmp_path, rows):
    path = str(tmp_path / "silver")
    df = spark.createDataFrame([("1", "1T", 2025, D(1), False), ("2", "2T", 2025, D(2), True)], "REG_ANS string, Trimestre string, Ano int, ValorDespesas decimal(15,2), DespesasSuspeitas boolean")
    tables.append_expenses(df, path)
    tables.append_expenses(df.limit(1), path)
    back = tables.read_table(spark, path)
    assert back.count() == 3
    assert (tmp_path / "silver" / "Ano=2025" / "Trimestre=1T").is_dir()


def test_staged_file_distinguishes_blank_and_missing(spark, tmp_path, rows):
    put(tmp_path / "s.csv", 'reg;t;a;v;s\n1;"1T";2025;"";\n', "utf-8")
    assert rows(read_staged(spark, str(tmp_path / "s.csv"), STAGED_EXPENSES)) == [("1", "1T", "2025", "", None)]


def test_consolidated_from_any_bronze_table(spark):
    df = spark.createDataFrame([("1", None, "d", "5", "/2024/4T/x")], "reg_ans string, data string, descricao string, valor string, source_file string")
    assert tuple(consolidated(df).first())[:4] == ("1", "4T", 2024, D("5.00"))


def test_quoted_fields_over_several_lines(spark, tmp_path, rows):
    put(tmp_path / "2025" / "1T" / "a.csv", 'REG_ANS;DESC;VALOR\n1;"despesa com evento\nsegunda";1\n2;despesa com evento;2\n3;5" despesa com evento;3\n')
    put(tmp_path / "2025" / "1T" / "b.csv", 'REG_ANS;DESC;VALOR\n4;"despesa com evento; ""x""";4\n')
    files = scan(spark, str(tmp_path))
    bronze = files.bronze()
    assert rows(bronze.select("reg_ans", "valor")) == [("1", "1"), ("2", "2"), ("3", "3"), ("4", "4")]
    assert files.skipped(bronze).count() == 0


def test_inner_quotes_hide_no_separators(spark, tmp_path, rows):
    put(tmp_path / "2025" / "1T" / "a.csv", 'REG_ANS;X;DESC;VALOR\n1;5" x;despesa com evento 6" y;1;extra\n2;a;despesa com evento;2\n')
    assert rows(scan(spark, str(tmp_path)).bronze().select("reg_ans", "valor")) == [("2", "2")]


def test_register_files_of_two_layouts(spark, tmp_path, rows):
    from quartermark.sources.delimited import read_register

    put(tmp_path / "a.csv", "REGISTRO_OPERADORA;CNPJ;RAZAO_SOCIAL;UF\n7;1;ALFA;SP\n")
    put(tmp_path / "b.csv", "UF,RAZAO_SOCIAL,REGISTRO_OPERADORA,CNPJ\nRJ,BETA,8,2\n")
    read = read_register(spark, str(tmp_path)).select("REGISTRO_OPERADORA", "CNPJ", "RAZAO_SOCIAL", "UF")
    assert rows(read) == [("7", "1", "ALFA", "SP"), ("8", "2", "BETA", "RJ")]


def test_very_long_quoted_fields(spark, tmp_path, rows):
    long = "despesa com evento " + "x" * 100_000
    put(tmp_path / "2025" / "1T" / "a.csv", f'REG_ANS;DESC;VALOR\n1;"{long}";1\n2;"{long} ""q""; z";2\n3;despesa com evento;3\n')
    put(tmp_path / "2025" / "1T" / "b.csv", f'REG_ANS;DESC;VALOR\n4;"{long}\n{long}";4\n5;"despesa com evento";5\n')
    files = scan(spark, str(tmp_path))
    bronze = files.bronze()
    assert rows(bronze.select("reg_ans", "valor")) == [(str(i), str(i)) for i in range(1, 6)]
    assert files.damaged_records().count() == 0


def test_a_quote_that_is_not_closed_loses_one_record(spark, tmp_path, rows):
    lines = [f"{i};despesa com evento;{i}" for i in range(1, 23)]
    lines[6] = '7;"despesa com evento;7'
    lines[14] = '15;"despesa com\nevento";15'
    put(tmp_path / "2025" / "1T" / "a.csv", "\n".join(["REG_ANS;DESC;VALOR", *lines, ""]))
    files = scan(spark, str(tmp_path))
    bronze = files.bronze()
    wanted = sorted((str(i), str(i)) for i in range(1, 23) if i not in (7, 15))
    assert rows(bronze.filter("reg_ans <> '15'").select("reg_ans", "valor")) == wanted
    assert [tuple(r)[1] for r in files.damaged_records().collect()] == [lines[6]]


@pytest.mark.parametrize("size", [9, 40, 1000])
def test_records_over_block_ends(spark, tmp_path, rows, size):
    from quartermark.sources.records import whole_records

    lines = [f'{i};"a{i}\nb;""{i}"" \n c";x' if i % 3 else f"{i};plain 5\" y;z" for i in range(60)]
    put(tmp_path / "a.csv", "\n".join(["h;i;j", *lines]))
    files = list_files(spark, str(tmp_path)).selectExpr("*", "';' AS sep", "0 AS layout", "'ISO-8859-1' AS encoding")
    found = whole_records(files, block_bytes=size)
    assert rows(found.select("value")) == sorted((x,) for x in lines)
    assert found.filter("damaged").isEmpty()
    ordered = [r["value"] for r in found.orderBy("block", "arrival").collect()]
    assert ordered == lines


def test_stream_reads_archives_and_names_rejects(spark, tmp_path, rows):
    from quartermark.streaming.ingest import rejected

    landing, target, offsets = (str(tmp_path / n) for n in ("landing", "target", "offsets"))
    header = "REG_ANS;DESC;VALOR\n"
    put(tmp_path / "landing" / "2025" / "1T" / "a.csv", header + '1;despesa com evento;1\n2;"despesa com evento;2\n')
    put(tmp_path / "landing" / "2025" / "1T" / "quiet.csv", header + "1;Receita;1\n")
    put(tmp_path / "landing" / "2025" / "1T" / "book.xlsx", "x")
    with zipfile.ZipFile(tmp_path / "landing" / "2025" / "2T.zip", "w") as archive:
        archive.writestr("m.csv", header + "3;despesa com evento;3\n")
        archive.writestr("n.csv", "X;Y\n3;4\n")
        archive.writestr("void.csv", "")
    put(tmp_path / "landing" / "2025" / "zero.csv", "")
    ingest(spark, landing, target, offsets).awaitTermination()
    put(tmp_path / "landing" / "nil.txt", "")
    (tmp_path / "landing" / "2025" / "bad.zip").write_bytes(b"no archive")
    ingest(spark, landing, target, offsets).awaitTermination()
    ingest(spark, landing, target, offsets).awaitTermination()
    assert rows(ingested(spark, target).select("REG_ANS", "Trimestre", "Ano")) == [("1", "1T", 2025), ("3", "2T", 2025)]
    named = sorted((r["source_file"].rsplit("/", 1)[1].rstrip("!"), r["motivo"]) for r in rejected(spark, target).collect())
    assert named == [
        ("a.csv", "unbalanced_quote"),
        ("bad.zip", "damaged_archive"),
        ("book.xlsx", "workbook"),
        ("n.csv", "no_value_column"),
        ("nil.txt", "empty_file"),
        ("quiet.csv", "no_keyword_match"),
        ("void.csv", "empty_file"),
        ("zero.csv", "empty_file"),
    ]


def test_register_columns_are_taken_by_name(spark, tmp_path, rows):
    from quartermark.plans.batch import ARRIVAL, staged_register
    from quartermark.operators.register import typed_register
    from quartermark.schemas import REGISTER_COLUMNS

    names = [c.upper() for c in REGISTER_COLUMNS]
    cells = {c: f"{c} 1" for c in REGISTER_COLUMNS} | {"registro_operadora": "7", "cnpj": "11"}
    put(tmp_path / "a.csv", ";".join(names[::-1]) + "\n" + ";".join(cells[c] for c in REGISTER_COLUMNS[::-1]) + "\n")
    put(tmp_path / "b.csv", ";".join(names) + "\n" + ";".join((cells | {"registro_operadora": "8"})[c] for c in REGISTER_COLUMNS) + "\n")
    typed = typed_register(staged_register(read_register(spark, str(tmp_path))), ARRIVAL)
    assert rows(typed.select("registro_operadora", "cnpj", "razao_social")) == [
        ("000007", "00000000000011", "razao_social 1"), ("000008", "00000000000011", "razao_social 1"),
    ]


def test_encoding_of_each_file(spark, tmp_path, rows):
    from quartermark.sources.delimited import BY_FILE

    lines = "".join(f"{i};Provisão de Eventos / Sinistros ação;{i}\n" for i in range(1, 4))
    put(tmp_path / "2025" / "1T" / "a.csv", "REG_ANS;DESCRICAO;VALOR\n" + lines, "utf-8")
    put(tmp_path / "2025" / "1T" / "b.csv", "REG_ANS;DESCRICAO;VALOR;SITUAÇÃO\n" + lines.replace("ação;", '"ação"\u00ff;'), "latin-1")
    put(tmp_path / "2025" / "1T" / "c.csv", "REG_ANS;SITUAÇÃO;DESCRICAO;VALOR\n" + '9;x;"Provisão de Eventos / Sinistros\nação";9\n', "utf-8")
    got = rows(scan(spark, str(tmp_path), BY_FILE).bronze().select("reg_ans", "descricao"))
    plain, other = "Provisão de Eventos / Sinistros ação", 'Provisão de Eventos / Sinistros "ação"ÿ'
    assert got == sorted([(str(i), t) for i in (1, 2, 3) for t in (plain, other)] + [("9", "Provisão de Eventos / Sinistros\nação")])
