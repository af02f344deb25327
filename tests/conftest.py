import pytest

from millrace.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def rows(df, *order):
    """Rows as tuples, ordered."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
