"""Incremental stage 1 gives the same rows as the batch formatter."""

import json
import os

from tidyrent.plans import format as fmt
from tidyrent.sources import files as SRC
from tidyrent.streaming.ingest import start_ingest


def test_stream_matches_batch(spark):
    land = SRC.scratch_dir(spark, "test-land")
    os.makedirs(land)
    rec = {c: None for c in fmt.RAW_TEXT_COLUMNS}
    a = dict(rec, descripcion="x", precio_soles="S/ 1,500", area_total="60 m² tot.", dormitorios="2 dorm. ",
             latitud="-12,1", longitud="-77,0", distrito="Chorillos")
    b = dict(rec, descripcion="y", precio_soles="US$900", fecha_publicacion="Publicado hoy")
    with open(os.path.join(land, "one.json"), "w", encoding="utf-8") as f:
        json.dump([a, b], f, ensure_ascii=False, indent=2)
    with open(os.path.join(land, "two.json"), "w", encoding="utf-8") as f:
        json.dump(a, f, ensure_ascii=False)
    out = SRC.scratch_dir(spark, "test-stream-out")
    q = start_ingest(spark, land, out, SRC.scratch_dir(spark, "test-stream-ckpt"), available_now=True)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    batch = fmt.format_listings(SRC.read_listing_folder(spark, land))
    cols = ["descripcion", "precio_soles", "area_total", "dormitorios", "latitud", "moneda", "fecha_publicacion"]
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == \
        sorted(map(tuple, batch.select(cols).collect()), key=str)
    assert got.count() == 3
