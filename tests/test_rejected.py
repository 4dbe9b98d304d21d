import os

import pytest
from conftest import HEADER

from saleslane.plans.ingestion import run_ingestion
from saleslane.sources.tables import read_layer, read_rejected

LINES = [
    "1,c1,p7,4,1.50,2023-03-05 08:30:00,Tea,Coast",
    "2,,p8,5,2.00,2023-03-05 09:00:00,Rice,Hills",
    "3,c1,,6,2.50,2023-03-05 10:15:00,Tea,Coast",
    "4,c3,p9,-7,0.25,2023-04-01 00:00:00,Salt,Plain",
    "5,,,0,,2023-04-01 00:00:00,,",
    "6,c1,p7,two,1.5,2023-03-05 08:30:00,Tea,Coast",
    "7,c1,p7",
    '8,c1,p7,4,1.50,2023-03-05 08:30:00,"Tea, green",',
    "9,c1,p7,4,1.50,never,Tea,Coast",
    "10,c1,p7,4,0,2023-03-05 08:30:00,Tea,~x",
]
REASONS = {
    2: ["customer_id is missing"],
    3: ["product_id is missing"],
    4: ["quantity is not above zero"],
    5: ["customer_id is missing", "product_id is missing", "quantity is not above zero", "price is missing"],
    6: ["quantity is missing"],
    7: ["quantity is missing", "price is missing"],
    10: ["price is not above zero"],
}


def files(folder):
    return sorted(f for _, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


@pytest.mark.parametrize("rebalance", [False, True])
def test_every_line_is_in_one_of_two_outputs(spark, write_csv, tmp_path, rebalance):
    raw, out, lost = write_csv(LINES), str(tmp_path / "out" / "d"), str(tmp_path / "rejected" / "d")
    spark.sparkContext.setJobGroup(f"split-{rebalance}", "")
    metrics = run_ingestion(spark, raw, out, "d", rebalance, rejected_path=lost)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"split-{rebalance}")
    assert len(jobs) == 2 + rebalance  # the headers, and one pass
    assert [(m.output, m.rows_in, m.rows_out, m.rows_rejected, m.rows_malformed) for m in metrics] == [
        ("processed", 10, 3, 7, 3),
        ("rejected", 10, 7, None, None),
    ]
    kept = read_layer(spark, out)
    assert kept.columns[-2:] == ["processed_at", "region"] and len(kept.columns) == 9
    assert sorted((r.id, r.region, r.category) for r in kept.collect()) == [
        (1, "Coast", "Tea"), (8, "UNKNOWN", "Tea, green"), (9, "Coast", "Tea"),
    ]
    rejected = {int(r.line.split(",")[0]): r for r in read_rejected(spark, lost).collect()}
    assert {i: r.reasons for i, r in rejected.items()} == REASONS
    # lines that do not fit are kept to the letter
    assert rejected[6].line == LINES[5] and rejected[7].line == LINES[6]
    assert rejected[2].line.startswith('2,,p8,5,2.0,2023-03-05T09:00:00')
    # what is written is what the outputs hold, and the same as without the split
    run_ingestion(spark, raw, str(tmp_path / "plain"), "d")
    plain = read_layer(spark, str(tmp_path / "plain"))
    assert sorted(map(str, plain.drop("processed_at").collect())) == sorted(map(str, kept.drop("processed_at").collect()))
    assert sorted(os.listdir(tmp_path / "out")) == ["d"] and sorted(os.listdir(tmp_path / "rejected")) == ["d"]
    assert len(files(lost)) <= 2


@pytest.mark.parametrize("lines", [[], LINES[:1], LINES[1:2]])
def test_outputs_without_rows(spark, write_csv, tmp_path, lines):
    out, lost = str(tmp_path / "out"), str(tmp_path / "lost")
    for _ in range(2):
        metrics = run_ingestion(spark, write_csv(lines), out, "d", rejected_path=lost)
        good = lines == LINES[:1]
        assert [m.rows_out for m in metrics] == [int(good), len(lines) - good]
        assert read_layer(spark, out, read_layer_schema()).count() == good
        assert read_rejected(spark, lost).count() == len(lines) - good


def read_layer_schema():
    from saleslane.schema import processed_schema

    return processed_schema()


def test_overlapping_outputs_are_refused(spark, write_csv, tmp_path):
    raw, out = write_csv(LINES), str(tmp_path / "out")
    for lost in (raw, out, f"{out}/inside"):
        with pytest.raises(ValueError, match="overlaps"):
            run_ingestion(spark, raw, out, "d", rejected_path=lost)
    assert not os.path.exists(out)
    assert HEADER
