"""Aggregates of one's own, by name in SQL.

An aggregate is a state with four steps: how it starts, how a row changes it, how two states become one, and
what it gives in the end. Tasks keep a state per group, states are merged behind the shuffle, and the name can
stand in SQL text beside any other aggregate. The steps are Java statements over primitive variables; the class
around them is compiled by the compiler that Spark brings for its own generated code and handed to the executors as
a jar in the shared folder.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property
from hashlib import sha256

from pyspark.sql import SparkSession

from clickflow.scratch import fresh_dir
from clickflow.storage import write_bytes

_PACKAGE = "clickflow.aggregates"
# The types that arguments, states and results may have: in Spark, in Java, as an object, and how a row gives them.
_TYPES = {
    "double": ("DoubleType", "double", "Double", "getDouble"),
    "bigint": ("LongType", "long", "Long", "getLong"),
    "boolean": ("BooleanType", "boolean", "Boolean", "getBoolean"),
    "string": ("StringType", "String", "String", "getString"),
}
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


@dataclass(frozen=True)
class UserAggregate:
    """``inputs``: argument names and types. ``state``: names, types and how they start.

    ``update`` sees the arguments and the state by their names and assigns to the state. ``merge`` does the same with
    the other state's values as ``other_<name>``. ``evaluate`` is an expression of ``result``'s type. A row with a
    null argument is passed over; no row gives what the first state gives. States must not be null.
    """

    name: str
    inputs: Mapping[str, str]
    state: Mapping[str, tuple[str, str]]
    update: str
    merge: str
    result: str
    evaluate: str

    def __post_init__(self) -> None:
        for name in (self.name, *self.inputs, *self.state):
            if not _NAME.fullmatch(name):
                raise ValueError(f"not a name: {name!r}")
        if set(self.inputs) & set(self.state):
            raise ValueError(f"arguments and state share names: {sorted(set(self.inputs) & set(self.state))}")
        for kind in (*self.inputs.values(), *(kind for kind, _ in self.state.values()), self.result):
            if kind not in _TYPES:
                raise ValueError(f"a type must be one of {', '.join(_TYPES)}, not {kind!r}")

    def _read(self, row: str, place: int, name: str, kind: str) -> str:
        _, java, _, get = _TYPES[kind]
        return f"    {java} {name} = {row}.{get}({place});"

    def _states(self, row: str, prefix: str = "") -> list[str]:
        return [self._read(row, i, prefix + n, kind) for i, (n, (kind, _)) in enumerate(self.state.items())]

    def _kept(self) -> list[str]:
        return [f"    state.update({i}, {_boxed(kind, n)});" for i, (n, (kind, _)) in enumerate(self.state.items())]

    @cached_property
    def body(self) -> str:
        def schema(fields: Mapping[str, str]) -> str:
            adds = "".join(f'.add("{n}", DataTypes.{_TYPES[kind][0]})' for n, kind in fields.items())
            return f"return new StructType(){adds};"

        starts = [f"    state.update({i}, {_boxed(kind, first)});" for i, (kind, first) in enumerate(self.state.values())]
        nulls = " || ".join(f"row.isNullAt({i})" for i in range(len(self.inputs))) or "false"
        arguments = [self._read("row", i, n, kind) for i, (n, kind) in enumerate(self.inputs.items())]
        return "\n".join(
            [
                f"  public StructType inputSchema() {{ {schema(self.inputs)} }}",
                f"  public StructType bufferSchema() {{ {schema({n: k for n, (k, _) in self.state.items()})} }}",
                f"  public DataType dataType() {{ return DataTypes.{_TYPES[self.result][0]}; }}",
                "  public boolean deterministic() { return true; }",
                "  public void initialize(MutableAggregationBuffer state) {",
                *starts,
                "  }",
                "  public void update(MutableAggregationBuffer state, Row row) {",
                f"    if ({nulls}) return;",
                *arguments,
                *self._states("state"),
                f"    {self.update}",
                *self._kept(),
                "  }",
                "  public void merge(MutableAggregationBuffer state, Row other) {",
                *self._states("state"),
                *self._states("other", "other_"),
                f"    {self.merge}",
                *self._kept(),
                "  }",
                "  public Object evaluate(Row state) {",
                *self._states("state"),
                f"    return {_boxed(self.result, self.evaluate)};",
                "  }",
            ]
        )

    @property
    def class_name(self) -> str:
        """Named by its content, so that a changed definition is another class."""
        return f"{self.name}_{sha256(self.body.encode()).hexdigest()[:16]}"

    @property
    def source(self) -> str:
        return "\n".join(
            [
                f"package {_PACKAGE};",
                "import org.apache.spark.sql.Row;",
                "import org.apache.spark.sql.expressions.MutableAggregationBuffer;",
                "import org.apache.spark.sql.expressions.UserDefinedAggregateFunction;",
                "import org.apache.spark.sql.types.DataType;",
                "import org.apache.spark.sql.types.DataTypes;",
                "import org.apache.spark.sql.types.StructType;",
                f"public class {self.class_name} extends UserDefinedAggregateFunction {{",
                self.body,
                "}",
            ]
        )


def _boxed(kind: str, value: str) -> str:
    return f"({value})" if kind == "string" else f"{_TYPES[kind][2]}.valueOf({value})"


#: Starts from 0.0: negative, NaN, null or no input gives 0.0, as ``sel_max`` does.
SEL_MAX = UserAggregate(
    name="sel_max",
    inputs={"value": "double"},
    state={"highest": ("double", "0.0")},
    update="if (value > highest) highest = value;",
    merge="if (other_highest > highest) highest = other_highest;",
    result="double",
    evaluate="highest",
)


def _jar(spark: SparkSession, aggregate: UserAggregate) -> str:
    """Compile the class and write it to the shared folder. A mistake in the steps is raised here."""
    jvm = spark.sparkContext._jvm
    compiler = jvm.org.codehaus.janino.SimpleCompiler()
    compiler.setParentClassLoader(jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader())
    try:
        compiler.cook(aggregate.source)
    except Exception as error:
        raise ValueError(f"{aggregate.name} does not compile: {error}") from error
    classes = compiler.getBytecodes()
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as jar:
        for name in classes:
            jar.writestr(f"{name.replace('.', '/')}.class", bytes(classes[name]))
    path = f"{fresh_dir(spark, 'aggregate')}/{aggregate.class_name}.jar"
    write_bytes(spark, path, packed.getvalue())
    return path


_JARS: dict[tuple[str, str], str] = {}


def register_aggregate(spark: SparkSession, aggregate: UserAggregate) -> None:
    """Give the aggregate its name in this session. Another one of that name is replaced."""
    key = (spark.sparkContext.applicationId, aggregate.class_name)
    if key not in _JARS:
        _JARS[key] = _jar(spark, aggregate)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {aggregate.name} AS '{_PACKAGE}.{aggregate.class_name}' "
        f"USING JAR '{_JARS[key]}'"
    )
