"""The command line, end to end on the hand-made extracts written as CSV files."""

import json
import os
import subprocess
import sys

from innkeeper import session
from innkeeper.sources import files
from tests.fixtures import raw

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    env = dict(os.environ, PYTHONPATH=REPO)
    out = subprocess.run(
        [sys.executable, "-m", "innkeeper", "--master", "local[2]", *args],
        capture_output=True, text=True, env=env, timeout=600, cwd=REPO,
    )
    return out.returncode, out.stdout.strip().splitlines()[-1] if out.stdout.strip() else "", out.stderr


def test_cli_staging_warehouse_questions(spark):
    root = session.scratch_path(spark, "test-cli")
    r = raw(spark)
    paths = {}
    for name, df in r.items():
        paths[name] = f"{root}/raw/{name}"
        files.write_csv(df, paths[name])
    code, _, err = _run("staging", *[a for n, p in paths.items() for a in (f"--{n}", p)], "--out", f"{root}/wh")
    assert code == 2 and "listing_id_date_unique" in err  # the planted duplicate is fatal
    code, line, err = _run("staging", *[a for n, p in paths.items() for a in (f"--{n}", p)],
                           "--out", f"{root}/wh", "--report-only")
    assert code == 0, err
    assert json.loads(line)["metrics"][0]["dropped"] == 1
    code, line, err = _run("warehouse", "--out", f"{root}/wh")
    assert code == 0, err
    built = json.loads(line)
    assert built["row_counts"]["fact_availability"] == 124
    code, line, err = _run("questions", "--warehouse", built["warehouse"], "--month", "2027-01",
                           "--range", "2027-01-10:2027-01-14")
    assert code == 0, err
    answers = json.loads(line)
    assert answers["q1_cheapest_most_available"][0]["listing_id"] == 4
    assert [x["listing_id"] for x in answers["q5_range_stay"]] == [3]
