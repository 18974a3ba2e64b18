import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from vicinage.sources import genbank, readers, sinks
from vicinage.streaming import ingest

TYPES = {"taxid": "long", "genome_size": "long", "gc_percent": "double"}


def tsv(tmp_path, *lines):
    p = tmp_path / "t.tsv"
    p.write_text("\n".join(lines) + "\n")
    return str(p)


def test_typed_tsv(spark, tmp_path):
    p = tsv(tmp_path, "#gc_percent\tassembly_accession\ttaxid\tisolate", "42.5\tGCA_1.1\t2\t001", "na\tGCA_2.1\tna\tx")
    got = rows(readers.typed_tsv(spark, p, TYPES, "assembly_accession", ["assembly_accession", "taxid", "isolate", "genome_size", "gc_percent"]))
    assert got == [("GCA_1.1", 2, "001", None, 42.5), ("GCA_2.1", None, "x", None, None)]


@pytest.mark.parametrize("lines", [("a\ta", "1\t2"), ("taxid", "1"), ("",), ("assembly_accession\ttaxid", "GCA_1.1\tx"), ("assembly_accession\ttaxid", "GCA_1.1"), ("assembly_accession\ttaxid", "GCA_1.1\t1\t2"), ("assembly_accession\ttaxid", "bad\t1")])
def test_bad_tsv(spark, tmp_path, lines):
    with pytest.raises(Exception):  # noqa: B017
        readers.typed_tsv(spark, tsv(tmp_path, *lines), TYPES, "assembly_accession", None, r"^GC[AF]_\d+").collect()


def test_contig_shapes(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([("GB1", "GCA_1", 100)], "genbankAccession string, assemblyAccession string, length bigint").write.parquet(a)
    spark.createDataFrame([("GB2", "RS2", "GCF_2", 200)], "genbankAccession string, refseqAccession string, assemblyAccession string, length bigint").write.parquet(b)
    assert rows(readers.contigs(spark, a, b).select("refseqAccession", "length")) == [(None, 100), ("RS2", 200)]
    assert readers.contigs(spark, a).where("refseqAccession is null").count() == 1
    with pytest.raises(ValueError):
        readers.drift_parquet(spark, [a], {"x": "string"}, ["x"])


def test_gff_and_fasta(spark, tmp_path):
    g = tmp_path / "x.gff"
    g.write_text("##gff-version 3\n#c\nctg1\tlocal\tCDS\t10\t39\t2.5\t+\t0\tID=p1;x=1\n")
    r = readers.gff(spark, str(g)).first()
    assert (r.seqid, r.start, r.score, r.phase, r.protein_id) == ("ctg1", 10, "2.5", "0", "p1")
    f = tmp_path / "x.fa"
    f.write_text(">a one\nMM\nKK\n>b\nAA\n")
    assert rows(readers.fasta(spark, str(f))) == [("a", "MMKK"), ("b", "AA")]


def test_ids_and_sheet(spark, tmp_path):
    p = tmp_path / "ids.txt"
    p.write_text("WP_000000001.1\n\nNC_000913.3:50-10\n")
    assert rows(readers.id_list(spark, str(p))) == [(0, "WP_000000001.1", None, None, None, "protein"), (2, "NC_000913.3", 10, 50, "-", "nucleotide")]
    s = tmp_path / "s.tsv"
    s.write_text("protein_id\tcustom\nWP_1\tx\n")
    df, extra = readers.input_sheet(spark, str(s), ["protein_id", "nucleotide_id", "uniprot_id", "input_type"])
    assert extra == ["custom"] and df.first().input_type == "protein"


def test_other_readers(spark, tmp_path):
    x = tmp_path / "r.csv"
    x.write_text("made today\nID,Sequence accession\n1,A\n,B\n2,C\n")
    assert rows(readers.strain_csv(spark, str(x), "accession").select("ID", "accession")) == [("1", "A"), ("1", "B"), ("2", "C")]
    st = tmp_path / "m.sto"
    st.write_text("#=GF ID Fam\n#=GF AC PF1.2\n#=GF DE A thing\n//\n")
    assert rows(readers.stockholm_metadata(spark, str(st))) == [("Fam", "PF1.2", "A thing", None)]
    d = tmp_path / "d.csv"
    d.write_text("x,a,b\na,0,1.5\nb,1.5,0\n")
    assert readers.distance_csv(spark, str(d)).agg(F.sum("dist")).first()[0] == 3.0
    j = tmp_path / "u.json"
    j.write_text('{"uniParcId": "U1", "uniParcCrossReferences": [{"database": "EMBL", "id": "E1", "version": 2, "active": true}, {"database": "RefSeq", "id": "R1", "version": 1, "active": false}]}\n')
    assert rows(readers.uniparc_best(spark, str(j))) == [("U1", "E1.2")]
    xml = tmp_path / "i.xml"
    xml.write_text('<r><IPGReport ipg="7" product_acc="p"><ProteinList><Protein accver="P1.1" source="RefSeq"><CDSList><CDS accver="N1" start="1" stop="9" strand="+" assembly="GCF_1" taxid="2"/></CDSList></Protein></ProteinList></IPGReport></r>')
    assert rows(readers.ipg_report(spark, str(xml)).select("ipg_id", "protein_id", "nucleotide_id", "end")) == [(7, "P1.1", "N1", 9)]


GB = """LOCUS       X
VERSION     NC_1.1
FEATURES             Location/Qualifiers
     CDS             complement(join(10..20,30..39))
                     /protein_id="p1"
                     /product="a ""b"" c"
                     /translation="MK
                     LL"
     gene            1..2
                     /locus_tag="t"
ORIGIN
//
LOCUS       Y
VERSION     NC_2.1
FEATURES             Location/Qualifiers
     CDS             5..8
                     /protein_id="p2"
//
"""


def test_genbank(spark, tmp_path):
    p = tmp_path / "x.gb"
    p.write_text(GB)
    df = genbank.read(spark, str(p))
    assert rows(df.select("seqid", "start", "end", "strand", "protein_id", "product", "translation")) == [("NC_1.1", 10, 39, "-", "p1", 'a "b" c', "MKLL"), ("NC_2.1", 5, 8, "+", "p2", None, None)]
    assert [r.protein_id for r in genbank.read(spark, str(p), "NC_2").collect()] == ["p2"]
    assert [r.protein_id for r in genbank.read(spark, str(p), "C_2").collect()] == ["p1"]


def test_publish_keeps_old_on_error(spark, tmp_path):
    target = str(tmp_path / "out")
    sinks.publish(spark.range(3), target)

    def bad(df):
        raise ValueError("no")

    with pytest.raises(ValueError):
        sinks.publish(spark.range(9), target, validate=bad)
    assert spark.read.parquet(target).count() == 3
    sinks.publish(spark.range(5), target)
    assert spark.read.parquet(target).count() == 5


def test_bundle(spark, tmp_path):
    out = str(tmp_path / "b")
    sinks.write_bundle({"gff": spark.createDataFrame([("c",)], "seqid string")}, out, dict.fromkeys(sinks.BUNDLE, "x string"), spark)
    assert all(spark.read.parquet(f"{out}/{n}.parquet") is not None for n in sinks.BUNDLE)
    assert sinks.unembed(sinks.embed(b"abc")) == b"abc"


def test_streams(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    schema = "k string, v int"
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], schema).coalesce(1).write.json(src)  # one file: batches come in any order
    ingest.append_parts(ingest.report_stream(spark, src, schema), out, ck).awaitTermination(60)
    assert spark.read.parquet(out).count() == 3
    table = str(tmp_path / "t")
    ingest.upsert_stream(ingest.report_stream(spark, src, schema, 1), ["k"], "v", table, str(tmp_path / "ck2")).awaitTermination(120)
    assert rows(ingest.upserted(spark, table, ("k",)).select("k", "v")) == [("a", 2), ("b", 3)]
    ingest.compact(spark, table, str(tmp_path / "c"), ("k",))
    assert spark.read.parquet(str(tmp_path / "c")).count() == 2
