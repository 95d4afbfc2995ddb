"""A key's state is read with one call to the state store: each call is a round trip to the JVM."""

from pyspark.sql import types as T

from millrace.streaming import stateful


class _Kept:
    """A value state that counts the calls made of it."""

    def __init__(self, value=None):
        self.value, self.calls = value, 0

    def exists(self):
        self.calls += 1
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value


class _Handle:
    def __init__(self, value=None):
        self.kept = _Kept(value)

    def getValueState(self, name, schema):
        return self.kept


ROWS = T.StructType([T.StructField("k", T.StringType()), T.StructField(stateful.TIME, T.TimestampType()),
                     T.StructField("v", T.LongType())])


def loaded(processor, value):
    handle = _Handle(value)
    processor.init(handle)
    got = processor.load(("k",))
    return got, handle.kept.calls


def test_a_station_is_read_with_one_call():
    assert loaded(stateful._Station(ROWS, stateful._ORDER, False), None) == (None, 1)
    assert loaded(stateful._Station(ROWS, stateful._ORDER, False), ("T1", "in", None, None, 4)) == (("T1", "in", None, None, 4), 1)


def test_panes_are_read_with_one_call():
    panes = lambda: stateful._Panes(ROWS, [stateful.TIME], False, "k", "v", 60, 3, 3)
    assert loaded(panes(), None) == (None, 1)
    assert loaded(panes(), (7, [1, 2])) == ((7, [1, 2]), 1)


def test_a_newest_row_is_read_with_one_call():
    assert loaded(stateful._Replaced(ROWS, ["v"], "k"), None) == (None, 1)
    assert loaded(stateful._Replaced(ROWS, ["v"], "k"), (3, "x")) == ((3, "x"), 1)
