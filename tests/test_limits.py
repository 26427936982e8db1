"""A dataset past its limit holds no other, whenever its Spark jobs start."""

import time

from lakegauge.plans import history


def test_jobs_that_start_after_the_limit_are_cancelled(spark):
    def asleep(batches):
        for b in batches:
            time.sleep(30)
            yield b

    def late():
        time.sleep(2)                                       # on the driver, past the limit
        return spark.range(0, 800, 1, 16).mapInArrow(asleep, "id long")

    def other():
        time.sleep(8)                                       # by now the other one's tasks would hold every core
        return spark.range(0, 100, 1, 4)

    spark.range(0, 8, 1, 8).mapInArrow(lambda batches: batches, "id long").collect()      # starts the workers
    began = time.monotonic()
    done, failed = history.run_all(spark, {"late": late, "other": other}, limits={"late": 0.5}, parallel=2)
    assert time.monotonic() - began < 25
    assert done.count() == 100
    assert [(r["dataset"], r["error"]) for r in failed.collect()] == [("late", "took longer than 0.5 seconds")]
