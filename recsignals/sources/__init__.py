from recsignals.sources.tables import TABLES, read_table, register_tables
from recsignals.sources.fixtures import FIXTURE_SQL, fixture, fixture_cte, register_fixtures

__all__ = ["TABLES", "read_table", "register_tables", "FIXTURE_SQL", "fixture",
           "fixture_cte", "register_fixtures"]
