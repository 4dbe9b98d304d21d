import os

import pytest
from conftest import HEADER

from saleslane.__main__ import arguments, main
from saleslane.operators.precheck import InputRejected
from saleslane.plans import daily
from saleslane.plans.daily import run_day
from saleslane.plans.ledger import fingerprint
from saleslane.plans.quality import CriticalFailure
from saleslane.sources.tables import layer_path, read_layer, read_rejected

LINES = [
    "1,c1,p7,4,1.50,2023-03-05 08:30:00,Tea,Coast",
    "2,c2,p8,5,2.00,2023-03-05 09:00:00,Rice,",
    "3,,p9,6,2.50,2023-03-05 10:15:00,Tea,Coast",
]
DATE, AS_OF = "2024-01-01", "2024-01-01 00:00:00"


@pytest.fixture
def base(write_csv, tmp_path):
    write_csv(LINES, f"raw/{DATE}")
    return str(tmp_path)


@pytest.fixture
def ran(monkeypatch):
    """The jobs that have run, by name."""
    done = []
    for name in ("run_ingestion", "run_transformation", "run_quality"):
        plain = getattr(daily, name)

        def counted(*args, name=name, plain=plain, **options):
            done.append(name.removeprefix("run_"))
            return plain(*args, **options)

        monkeypatch.setattr(daily, name, counted)
    return done


def counts(metrics):
    return [(r.stage, r.output, r.rows_in, r.rows_out) for r in metrics.collect()]


def test_a_run_goes_on_where_the_last_one_failed(spark, base, ran, monkeypatch):
    plain = daily.run_transformation

    def broken(*args, **options):
        plain(*args, **options)
        raise RuntimeError("lost")

    monkeypatch.setattr(daily, "run_transformation", broken)
    with pytest.raises(RuntimeError, match="lost"):
        run_day(spark, base, DATE, as_of=AS_OF)
    assert ran == ["ingestion", "transformation"]
    monkeypatch.setattr(daily, "run_transformation", plain)
    first = counts(run_day(spark, base, DATE, as_of=AS_OF))
    assert ran == ["ingestion", "transformation", "transformation", "quality"]
    # all has finished: nothing runs, and the counts are the same
    assert counts(run_day(spark, base, DATE, as_of=AS_OF)) == first and len(ran) == 4
    assert [c[1] for c in first][:2] == ["processed", "transformed_sales"]
    run_day(spark, base, DATE, as_of=AS_OF, resume=False)
    assert ran[4:] == ["ingestion", "transformation", "quality"]


def test_what_makes_a_stage_run_again(spark, base, ran, tmp_path):
    def again(**options):
        ran.clear()
        run_day(spark, base, DATE, **{"as_of": AS_OF, **options})
        return list(ran)

    assert again() == ["ingestion", "transformation", "quality"]
    assert again() == []
    assert again(as_of=None) == ["quality"]  # its rules follow the clock
    assert again(as_of=None) == ["quality"]
    assert again(money_scale=3) == ["transformation", "quality"]
    more = tmp_path / "raw" / DATE / "more.csv"
    more.write_text(f"{HEADER}\n9,c9,p7,4,1.50,2023-03-05 08:30:00,Tea,Coast\n")
    assert again(money_scale=3) == ["ingestion", "transformation", "quality"]
    more.write_text(f"{HEADER}\n8,c9,p7,4,1.50,2023-03-05 08:30:00,Tea,Coast\n")  # as long as before
    os.utime(more, (1, 1))
    assert again(money_scale=3) == ["ingestion", "transformation", "quality"]
    # a table that somebody else has replaced or removed
    fact = f"{layer_path(base, 'transformed', DATE)}/transformed_sales"
    os.rename(fact, f"{tmp_path}/elsewhere")
    assert again(money_scale=3) == ["transformation", "quality"]
    assert read_layer(spark, fact).count() == 3


def test_a_verdict_is_given_again(spark, tmp_path, write_csv, ran):
    write_csv(LINES[:1] * 102, f"raw/{DATE}")
    for _ in range(2):
        with pytest.raises(CriticalFailure, match="1 checks failed"):
            run_day(spark, str(tmp_path), DATE, as_of=AS_OF)
        assert ran == ["ingestion", "transformation", "quality"]


def test_failures_that_may_pass_are_tried_again(spark, base, monkeypatch):
    tries = []
    plain = daily.run_ingestion

    def shaky(*args, **options):
        tries.append(1)
        if len(tries) < 3:
            raise OSError("no connection")
        return plain(*args, **options)

    monkeypatch.setattr(daily, "run_ingestion", shaky)
    with pytest.raises(OSError):
        run_day(spark, base, DATE, ["ingestion"], retries=1)
    tries.clear()
    run_day(spark, base, DATE, ["ingestion"], retries=2)
    assert len(tries) == 3
    tries.clear()
    with open(f"{base}/raw/{DATE}/bad.csv", "w") as bad:
        bad.write("price\n1\n")
    with pytest.raises(InputRejected):
        run_day(spark, base, DATE, ["ingestion"], retries=5)
    assert tries == []


def test_rejected_lines_and_lifetime_tiers_of_a_day(spark, base, write_csv):
    write_csv(["7,c1,p7,800,1.50,2023-03-06 08:30:00,Tea,Coast", "8,c3,p7,1,1,2023-03-06 08:30:00,Tea,Coast"], "raw/2024-01-02")
    write_csv(["9,c1,p7,1,1.50,2023-03-07 08:30:00,Tea,Coast"], "raw/2024-01-03")
    options = {"stages": ["ingestion", "transformation"], "lifetime": True, "keep_rejected": True}
    metrics = counts(run_day(spark, base, DATE, **options))
    assert metrics[:2] == [("ingestion", "processed", 3, 2), ("ingestion", "rejected", 3, 1)]
    assert [r.reasons for r in read_rejected(spark, layer_path(base, "rejected", DATE)).collect()] == [["customer_id is missing"]]
    for _ in range(2):  # done again, a day does not count twice
        for date in ("2024-01-02", "2024-01-03"):
            run_day(spark, base, date, resume=False, **options)
    fact = read_layer(spark, f"{layer_path(base, 'transformed', '2024-01-03')}/transformed_sales")
    assert [(r.customer_total_spent, r.customer_category) for r in fact.collect()] == [(1207.5, "Silver")]
    totals = read_layer(spark, layer_path(base, "customer_totals", "2024-01-03"))
    assert sorted(map(tuple, totals.collect())) == [("c1", 1207.5, 3), ("c2", 10.0, 1), ("c3", 1.0, 1)]
    # an earlier day that changes makes the later one run again
    run_day(spark, base, "2024-01-02", resume=False, **options)
    run_day(spark, base, "2024-01-03", **options)
    # the empty region is still the empty text
    first = read_layer(spark, layer_path(base, "processed", DATE))
    assert {r.id: r.region for r in first.collect()} == {1: "Coast", 2: "UNKNOWN"}


def test_fingerprints(spark, tmp_path):
    assert fingerprint(spark, str(tmp_path / "nothing")) is None
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_text("1")
    one = fingerprint(spark, str(tmp_path / "a"))
    assert one == fingerprint(spark, str(tmp_path / "a"))
    (tmp_path / "a" / "y.csv").write_text("1")
    assert one != fingerprint(spark, str(tmp_path / "a"))


def test_options_on_the_command_line(spark, base, capsys):
    text = "day --base b --date d --retries 2 --no-resume --keep-rejected --lifetime --schema"
    day = arguments([*text.split(), "id long, region string"])
    assert day.schema.fieldNames() == ["id", "region"] and day.retries == 2
    assert not day.resume and day.keep_rejected and day.lifetime and not day.allow_empty
    main(["day", "--base", base, "--date", DATE, "--stages", "ingestion", "--keep-rejected"])
    assert "rejected" in capsys.readouterr().out
    main(["day", "--base", base, "--date", DATE, "--stages", "transformation", "--money-scale", "3"])
    assert "product_summary" in capsys.readouterr().out
    main(["quality", "--input-path", layer_path(base, "transformed", DATE), "--date", DATE, "--as-of", "2000-01-01 00:00:00"])
    assert "future_transaction_date" in capsys.readouterr().out
