"""

* frames/s of the backdrop-removal operator on 480x640 colour frames
  (derived from `embeddings`) with local[1], local[2], local[4];
* landing-folder stream: micro-batch time against maxFilesPerTrigger.

Each configuration runs in its own Spark process. Usage:
    python scripts/measure.py [sf_dir]
"""

import json
import os
import subprocess
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def child(mode: str, sf_dir: str, cpus: int, per_trigger: int, scratch: str):
    sys.path.insert(0, ROOT)
    from pyspark.sql import functions as F

    import bench
    from backdrop.config import make_session
    from backdrop.functions.segmenters import ThresholdSegmenter
    from backdrop.operators import frames as FO
    from backdrop.sinks import frames as SK
    from backdrop.sources import tables as V
    from backdrop.streaming import jobs as J

    spark = make_session(cores=cpus, app="backdrop-measure")
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    hd_path = os.path.join(scratch, "hd")
    if not os.path.exists(hd_path):
        emb = V.table(spark, sf_dir, "embeddings")
        bench.upscale(V.frames(emb, "grey").repartition(32), *bench.HD).write.parquet(hd_path)
    hd = spark.read.parquet(hd_path)
    n = hd.count()
    if mode == "cores":
        run = lambda: FO.remove_backdrop(hd, ThresholdSegmenter(153)).write.format("noop").mode("overwrite").save()
        run()  # warm-up
        t0 = time.perf_counter()
        run()
        dt = time.perf_counter() - t0
        print(json.dumps({"cores": cpus, "frames": n, "sec": round(dt, 3), "frames_per_sec": round(n / dt, 1)}))
    else:
        pngs = os.path.join(scratch, "png")
        if not os.path.exists(pngs):
            SK.export_png(hd.withColumn("status", F.lit("success")).withColumn("message", F.lit(None).cast("string")),
                          pngs).write.format("noop").mode("overwrite").save()
        out = tempfile.mkdtemp(dir=scratch)
        q = J.run_frame_stream(spark, pngs, os.path.join(out, "o"), os.path.join(out, "c"),
                               max_files_per_trigger=per_trigger)
        t0 = time.perf_counter()
        J.drain(q)
        dt = time.perf_counter() - t0
        b = [p["durationMs"].get("triggerExecution", 0) / 1000 for p in q.recentProgress if p["numInputRows"]]
        print(json.dumps({"files_per_trigger": per_trigger, "batches": len(b), "mean_batch_sec": round(sum(b) / len(b), 3),
                          "frames_per_sec": round(n / dt, 1)}))
    spark.stop()


def main():
    if len(sys.argv) > 1 and sys.argv[1] == "--child":
        child(sys.argv[2], sys.argv[3], int(sys.argv[4]), int(sys.argv[5]), sys.argv[6])
        return
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="backdrop-measure-")
    runs = [("cores", c, 0) for c in (1, 2, 4)] + [("stream", 4, k) for k in (50, 250, 1000)]
    for mode, cpus, k in runs:
        res = subprocess.run([sys.executable, __file__, "--child", mode, sf_dir, str(cpus), str(k), scratch],
                             capture_output=True, text=True, timeout=1800)
        lines = [x for x in res.stdout.splitlines() if x.startswith("{")]
        print(lines[-1] if lines else f"{mode} {cpus} {k} failed: {res.stderr[-500:]}", flush=True)


if __name__ == "__main__":
    main()
