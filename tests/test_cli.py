import json
import os
import subprocess
import sys

from conftest import ROOT, SF01


def _run(*args):
    out = subprocess.run([sys.executable, "-m", "clickwin", *args, "--master", "local[2]"],
                         cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_cli_launches_advance_the_window(tmp_root):
    common = ["--store", tmp_root, "--events", os.path.join(SF01, "events.parquet"),
              "--step", "24", "--default-start", "2024010100", "--now", "2024-03-01 00:00:00"]
    first = _run("label", *common)
    second = _run("label", *common)
    assert (first["status"], first["end"]) == ("done", "2024010200")
    assert (second["start"], second["end"]) == ("2024010200", "2024010300")


def test_cli_minute_and_day_jobs(tmp_root):
    events = os.path.join(SF01, "events.parquet")
    minute = _run("label", "--store", f"{tmp_root}/m", "--events", events, "--step", "10", "--unit", "MIMUE",
                  "--pattern", "yyyyMMddHHmm", "--guard", "end", "--null-as-empty", "--gate", "any_later",
                  "--default-start", "202401010100", "--now", "2024-03-01 00:00:00")
    assert (minute["status"], minute["end"]) == ("done", "202401010110")
    day = _run("label", "--store", f"{tmp_root}/d", "--events", events, "--unit", "DAY", "--pattern", "yyyyMMdd",
               "--gate", "any_later", "--default-start", "20240103", "--now", "2024-03-01 00:00:00")
    assert (day["status"], day["end"]) == ("done", "20240104")
