"""Check suites as SQL: every check counted on its own, for the independent oracle."""

from __future__ import annotations


class SuiteSql:
    """The checks of one table; ``relation`` is a table name or a subquery."""

    def __init__(self, table: str, relation: str):
        self.table, self.relation = table, relation
        self.rows: list[str] = []

    def counted(self, name: str, count: str, severity: str = "error") -> SuiteSql:
        """``count`` is a query with one row and one column, ``n``."""
        self.rows.append(
            f"""
            select '{self.table}' as table_name, '{name}' as check_name, '{severity}' as severity,
                   cast(n as bigint) as failing_rows,
                   case when n = 0 then 'pass' else '{severity}' end as status
            from ({count})"""
        )
        return self

    def rows_where(self, name: str, condition: str) -> SuiteSql:
        return self.counted(name, f"select count(*) as n from {self.relation} t where {condition}")

    def unique(self, *columns: str) -> SuiteSql:
        for c in columns:
            groups = f"select 1 from {self.relation} t where {c} is not null group by {c}"
            self.counted(f"unique({c})", f"select count(*) as n from ({groups} having count(*) > 1)")
        return self

    def grain(self, *columns: str) -> SuiteSql:
        keys = ", ".join(columns)
        groups = f"select 1 from {self.relation} t group by {keys} having count(*) > 1"
        return self.counted(f"grain_unique({keys})", f"select count(*) as n from ({groups})")

    def present(self, *columns: str) -> SuiteSql:
        for c in columns:
            self.rows_where(f"not_null({c})", f"{c} is null")
        return self

    def listed(self, column: str, *values: str) -> SuiteSql:
        among = ", ".join(f"'{v}'" for v in values)
        return self.rows_where(f"accepted_values({column})", f"{column} not in ({among})")

    def known(self, column: str, parent: str) -> SuiteSql:
        return self.rows_where(
            f"relationships({column} -> {column})",
            f"{column} is not null and {column} not in "
            f"(select {column} from {parent} where {column} is not null)",
        )


def suites_sql(*suites: SuiteSql) -> str:
    return " union all ".join(row for suite in suites for row in suite.rows)
