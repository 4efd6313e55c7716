import os

from lakemart.streaming.ingest import stream_edition_to_bronze


def _write(path, rows):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write('Token,"Área de Formação",multi\n')
        for r in rows:
            fh.write(",".join(f'"{v}"' for v in r) + "\n")


def test_stream_ingests_only_new_files(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    bronze = os.path.join(tmp_dir, "bronze")
    ckpt = os.path.join(tmp_dir, "ckpt")
    _write(os.path.join(raw, "part1.csv"), [("t1", "Computação", "a\nb"), ("t2", "Economia", "")])
    q = stream_edition_to_bronze(spark, 2025, raw, bronze, ckpt, "2025-01-01T00:00:00+00:00")
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(bronze, "ano=2025"))
    assert out.columns == ["token", "area_de_formacao", "multi",
                           "_ano_pesquisa", "_arquivo_origem", "_data_ingestao"]
    assert out.count() == 2
    assert out.where("token = 't1'").first().multi == "a\nb"

    _write(os.path.join(raw, "part2.csv"), [("t3", "Física", "x")])
    q = stream_edition_to_bronze(spark, 2025, raw, bronze, ckpt, "2025-01-02T00:00:00+00:00")
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(bronze, "ano=2025"))
    assert out.count() == 3                       # part1 not ingested twice
    files = {r._arquivo_origem: r._data_ingestao for r in out.collect()}
    assert files == {"part1.csv": "2025-01-01T00:00:00+00:00",
                     "part2.csv": "2025-01-02T00:00:00+00:00"}
