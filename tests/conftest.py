import pytest

from rowloom import session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    active = session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="6g", spark__sql__catalogImplementation="in-memory",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    active.sparkContext.setLogLevel("ERROR")
    yield active


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(type(v)), v) if not isinstance(v, (list, dict)) else (False, "", str(v)) for v in r))

    return collect
