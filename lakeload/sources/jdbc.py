"""JDBC sources: whole, filtered, SQL, range-partitioned and hash-predicated reads.

All reads go through Spark's JDBC data source, so filters and column lists are pushed into the
database query.  Credentials are passed as options and never logged.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


def bucket_predicates(key_expr: str, n: int, template: str = "MOD(MOD({key}, {n}) + {n}, {n}) = {k}") -> list[str]:
    """The predicates of ``n`` buckets; bucket 0 takes the rows whose key is NULL."""
    preds = [template.format(key=key_expr, n=n, n1=n - 1, k=k) for k in range(n)]
    return [f"({preds[0]}) OR ({key_expr}) IS NULL", *preds[1:]]


@dataclass
class JdbcSource:
    url: str
    table: str | None = None          # "schema.object", or a parenthesised subquery with an alias
    query: str | None = None          # SELECT text (Spark's ``query`` option)
    options: dict = field(default_factory=dict)  # user, password, driver, fetchsize, customSchema, ...

    def reader(self, spark: SparkSession):
        r = spark.read.format("jdbc").option("url", self.url)
        for k, v in self.options.items():
            r = r.option(k, v)
        return r

    def read(self, spark: SparkSession) -> DataFrame:
        r = self.reader(spark)
        if self.query is not None:
            return r.option("query", self.query).load()
        return r.option("dbtable", self.table).load()

    def read_ranges(self, spark: SparkSession, column: str, lower: int, upper: int,
                    partitions: int = 4) -> DataFrame:
        """Split the read into ``partitions`` key ranges, one task (and one database query) each."""
        return (self.reader(spark).option("dbtable", self.table)
                .option("partitionColumn", column).option("lowerBound", str(lower))
                .option("upperBound", str(upper)).option("numPartitions", str(partitions)).load())

    def read_buckets(self, spark: SparkSession, key_expr: str, n: int,
                     template: str = "MOD(MOD({key}, {n}) + {n}, {n}) = {k}") -> DataFrame:
        """Split the read into ``n`` disjoint predicates over a hash or numeric key expression.

        ``template`` is the database's own spelling (for example ``ORA_HASH({key}, {n1}) = {k}``).  Every row
        meets exactly one predicate: negative keys are brought into 0..n-1 and NULL keys go to bucket 0.
        """
        preds = bucket_predicates(key_expr, n, template)
        props = {"url": self.url, **{k: str(v) for k, v in self.options.items()}}
        return spark.read.jdbc(self.url, self.table, predicates=preds, properties=props)

    def as_of(self, scn_clause: str) -> "JdbcSource":
        """The same table read at one snapshot, e.g. ``AS OF SCN 12345``: the clause is put inside the
        table expression so every partition query reads the same snapshot."""
        return JdbcSource(self.url, f"(SELECT * FROM {self.table} {scn_clause}) t", None, dict(self.options))
