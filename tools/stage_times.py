"""Stage / task times from a Spark event log folder (zstd or plain)."""
import collections
import glob
import json
import sys

import zstandard


def lines(path):
    for f in sorted(glob.glob(path + "/**/events_*", recursive=True)):
        with open(f, "rb") as fh:
            if f.endswith(".zstd"):
                r = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
                data = b"".join(iter(lambda: r.read(1 << 20), b""))
            else:
                data = fh.read()
        yield from data.decode(errors="replace").splitlines()


def main(path):
    stages, tasks = {}, collections.defaultdict(list)
    for line in lines(path):
        try:
            e = json.loads(line)
        except ValueError:
            continue
        if e["Event"] == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Stage Name"][:40], si["Number of Tasks"],
                                      si.get("Submission Time"), si.get("Completion Time"))
        elif e["Event"] == "SparkListenerTaskEnd":
            ti, tm = e["Task Info"], e.get("Task Metrics") or {}
            tasks[e["Stage ID"]].append((ti["Finish Time"] - ti["Launch Time"],
                                         tm.get("Executor CPU Time", 0) / 1e9))
    for sid, (name, n, s0, s1) in sorted(stages.items()):
        d = tasks[sid]
        wall = (s1 - s0) / 1000 if s0 and s1 else 0
        if wall < 0.5:
            continue
        print(f"stage {sid:3d} tasks {n:4d} wall {wall:6.1f}s max-task {max(x[0] for x in d)/1000:6.1f}s "
              f"cpu {sum(x[1] for x in d):7.1f}s  {name}")


if __name__ == "__main__":
    main(sys.argv[1])
