import inspect

import pytest

from wakeframe.operators import learn as L
from wakeframe.suite import load

SIZES = {"trees", "depth", "rate", "size", "iterations", "row_share", "column_share"}


class Caught(Exception):
    pass


@pytest.mark.parametrize(
    "name, trainer",
    [
        ("boosted_trees", "train_boosted"),
        ("kernel_machine", "train_kernel"),
        ("feature_importance", "train_boosted"),
        ("batch_scores", "train_boosted"),
        ("stream_scores", "train_boosted"),
    ],
)
def test_registered_queries_train_whole_models(spark, monkeypatch, name, trainer):
    signature = inspect.signature(getattr(L, trainer))

    def caught(*args, **given):
        raise Caught(signature.bind(*args, **given).arguments)

    monkeypatch.setattr(L, trainer, caught)
    with pytest.raises(Caught) as found:
        load()[0][name](spark, "/root/testdata/sf0.001")
    assert not SIZES & set(found.value.args[0])
