"""Stage times of one builder from Spark's event log (no UI, no server).

    python tools/stage_times.py <builder> [sf_dir]

Runs the builder twice (the second run is the warm one) over the stand-ins
of ``sf_dir`` with the event log written to a fresh scratch folder, then
prints the slowest stages of the warm run with their task counts.
"""

import glob
import inspect
import json
import sys
import tempfile
import time

sys.path.insert(0, ".")

import zstandard  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from tidewater.plans import asn, compliance  # noqa: E402
from tidewater.plans.queries import AS_OF, sources  # noqa: E402
from tidewater.session import configure  # noqa: E402


def main() -> None:
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-evlog-")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.sql.shuffle.partitions", "16").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    fn = getattr(asn, name, None) or getattr(compliance, name)
    t = sources(spark, sf_dir)
    run = (lambda: fn(t, AS_OF)) if len(inspect.signature(fn).parameters) > 1 else (lambda: fn(t))
    marks = []
    for _ in range(2):
        marks.append(time.time() * 1000)
        run().write.format("noop").mode("overwrite").save()
    spark.stop()
    stages = []
    for f in glob.glob(f"{log_dir}/*/events*"):
        with open(f, "rb") as fh:
            raw = fh.read()
        try:
            raw = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
        except zstandard.ZstdError:
            pass
        for line in raw.decode("utf-8", "replace").splitlines():
            e = json.loads(line) if line.startswith("{") else {}
            if e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                if si["Submission Time"] >= marks[1]:
                    stages.append((si["Completion Time"] - si["Submission Time"], si["Stage ID"],
                                   si["Number of Tasks"]))
    for ms, sid, n in sorted(stages, reverse=True)[:12]:
        print(f"stage {sid:5d}  {ms:7d} ms  {n:4d} tasks")
    print(f"warm stages: {len(stages)}, summed {sum(s[0] for s in stages)} ms, log in {log_dir}")


if __name__ == "__main__":
    main()
