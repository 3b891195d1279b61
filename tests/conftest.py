import pytest

from tests.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(cores=4, warehouse=str(tmp_path_factory.mktemp("warehouse")))
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, columns in the order given."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=repr)

    return collect
