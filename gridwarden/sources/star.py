"""Adapters that lay the network's tables over a TPC-H-like star schema.

The tables of a real network are not public, so the queries run on views of star-schema tables. The
expressions are the same for Spark and for any engine with `%`, `cast(x as string)` and date
literals; see FIXTURES.md.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession

from gridwarden.sources.catalog import catalog_frames, create_database, quoted, registered_layers
from gridwarden.sources.network import Network


@dataclass(frozen=True)
class Adapter:
    """Columns over one star table, for the rows that meet a condition."""

    star: str
    columns: list[str]
    where: str = "true"

    @property
    def sql(self) -> str:
        return f"select {', '.join(self.columns)} from {self.star} where {self.where}"


def _audit(key: str) -> list[str]:
    return [
        f"'u' || cast({key} % 3 as string) usuarioregistro",
        f"case when {key} % 2 = 0 then date '2015-01-01' else date '2015-02-04' end fecharegistro",
        "cast(null as string) usuariomodificacionregistro",
        f"case when {key} % 7 = 0 then date '2015-03-01' end fechamodificacionregistro",
    ]


def _feature(key: str, feeder: str, phase: str) -> list[str]:
    return [f"{key} objectid", f"cast({feeder} % 25 as string) alimentadorid", f"{phase} faseconexion"]


def _info(key: str, phase: str) -> str:
    info = "when 4 then 1 when 2 then 2 when 1 then 4 when 5 then 5 when 6 then 3 when 3 then 6 when 7 then 7"
    return f"case when {key} % 5 = 0 then 9 else case {phase} {info} end end alimentadorinfo"


def _ids(key: str, **prefixes: str) -> list[str]:
    return [f"'{prefix}' || cast({key} as string) {name}" for name, prefix in prefixes.items()]


def _order(key: str, every: int) -> str:
    return f"case when {key} % {every} = 0 then null else 'OT' || cast({key} as string) end ordentrabajo"


def _span(quarter: int, columns: list[str]) -> Adapter:
    phase = "nullif(l_partkey % 9, 8)"
    common = [
        *_feature("l_orderkey * 10 + l_linenumber", "l_partkey", phase),
        _info("l_partkey", phase),
        "cast(l_suppkey % 10 as int) subtipo",
    ]
    return Adapter("lineitem", [*common, *columns, *_audit("l_partkey")], f"l_orderkey % 4 = {quarter}")


_MEDIUM = [
    "case when l_partkey % 23 = 0 then 7960.5 when l_partkey % 2 = 0 then 7960 else 13800 end voltaje",
    "case when l_partkey % 11 = 0 then null when l_partkey % 29 = 0 then '' else 'E' || cast(l_partkey as string) end "
    "codigoconductorfase",
    "case l_partkey % 4 when 0 then 'COO0000' when 1 then null else 'E' || cast(l_partkey as string) end "
    "codigoconductorneutro",
    "case l_partkey % 10 when 0 then '11' when 1 then '12' when 2 then '22' when 3 then '23' when 4 then '33' "
    "when 5 then '34' when 6 then '13' when 7 then '25' when 8 then '1' end configuracionconductores",
    "case l_suppkey % 8 when 0 then 'A' when 1 then 'B' when 2 then 'C' when 3 then 'AB' when 4 then 'CB' "
    "when 5 then 'AC' when 6 then 'CBA' end secuenciafase",
]
_LOW = [
    "case when l_linenumber = 1 then 'PD' || cast(l_suppkey as string) else 'CS' || cast(l_orderkey as string) end "
    "parentcircuitsourceguid"
]

ADAPTERS: dict[str, Adapter] = {
    "tramodistribucionaereo": _span(0, _MEDIUM),
    "tramodistribucionsubterraneo": _span(1, _MEDIUM),
    "tramobajatensionaereo": _span(2, _LOW),
    "tramobajatensionsubterraneo": _span(3, _LOW),
    "puestotransfdistribucion": Adapter(
        "orders",
        [
            *_feature("o_orderkey", "o_orderkey", "nullif(o_orderkey % 9, 8)"),
            *_ids("o_orderkey", globalid="PT", circuitsourceguid="CS"),
            _info("o_orderkey", "nullif(o_orderkey % 9, 8)"),
            "cast(o_custkey % 14 as int) subtipo",
            "cast(o_orderkey % 4 * 12.5 as decimal(18,3)) potenciakva",
            "case when o_orderkey % 17 = 0 then null else 1 end configuracionladobaja",
            "case when o_orderkey % 19 = 0 then null else 1 end configuracionladomedia",
            _order("o_orderkey", 3),
            *_audit("o_orderkey"),
        ],
    ),
    "unidadtransfdistribucion": Adapter(
        "lineitem",
        [
            "l_orderkey * 10 + l_linenumber objectid",
            "case when l_partkey % 2 = 0 then 'PT' else 'XT' end || cast(l_orderkey as string) puestotransfdistglobalid",
            "case l_partkey % 4 when 0 then 1 when 1 then 2 when 2 then 4 end faseconexion",
            "case when l_suppkey % 8 = 6 then 5.5 else nullif(l_suppkey % 8, 7) end tapnormal",
            "case when l_partkey % 6 = 0 then null else cast(12.5 as decimal(18,3)) end potencianominal",
        ],
    ),
    "puestoseccionadorfusible": Adapter(
        "part",
        [
            *_feature("p_partkey", "p_partkey", "nullif(p_partkey % 9, 8)"),
            *_ids("p_partkey", globalid="SF"),
            _info("p_partkey", "nullif(p_partkey % 9, 8)"),
            "cast(p_partkey % 4 as int) subtipo",
            "case when p_partkey % 23 = 0 then 13800.4 when p_partkey % 2 = 0 then 7960 else 13800 end voltaje",
            "cast(p_partkey % 3 * 100 + 100 as string) corriente",
            "'E' || cast(p_partkey as string) codigoestructura",
            _order("p_partkey", 4),
            *_audit("p_partkey"),
        ],
    ),
    "catalogoestructura": Adapter(
        "part",
        [
            "case when p_partkey % 43 in (39, 40) then 'N' else 'E' end || cast(p_partkey as string) codigoestructura",
            "case when p_partkey % 10 = 0 then '1S' else cast(p_partkey % 3 + 1 as string) || "
            "case p_partkey % 3 when 0 then 'S' when 1 then 'D' else 'E' end || "
            "cast(p_partkey % 2 * 100 + 100 as string) end descripcioncorta",
        ],
    ),
    "unidadfusible": Adapter(
        "lineitem",
        [
            "l_orderkey * 10 + l_linenumber objectid",
            "case when l_orderkey % 16 = 0 then 'SF' else 'XF' end || cast(l_partkey as string) puestosecfusibleglobalid",
            "case l_suppkey % 5 when 0 then '' when 1 then null else cast(l_suppkey % 5 as string) end capacidad",
        ],
    ),
    "puestocorrectorfactorpotencia": Adapter(
        "customer",
        [
            *_feature("c_custkey", "c_custkey", "nullif(c_custkey % 9, 8)"),
            *_ids("c_custkey", globalid="CA"),
            "cast(c_custkey % 4 * 12.5 as decimal(18,3)) potenciakva",
            *_audit("c_custkey"),
        ],
    ),
    "unidadcapacitor": Adapter(
        "orders",
        [
            "o_orderkey objectid",
            "case when o_orderkey % 5 = 0 then 'CA' else 'XA' end || cast(o_custkey as string) puestocorrfacpotglobalid",
            "case when o_orderkey % 97 = 0 then '12 kVA' when o_orderkey % 3 = 0 then '12.5' when o_orderkey % 3 = 1 then '12,5' "
            "when o_orderkey % 7 = 0 then '' end potencianominal",
        ],
    ),
    "puestoprotecciondinamico": Adapter(
        "supplier",
        [
            *_feature("s_suppkey", "s_suppkey", "nullif(s_suppkey % 9, 8)"),
            *_ids("s_suppkey", circuitsourceguid="PD"),
            "case when s_suppkey % 3 = 0 then 'PD' || cast(s_suppkey as string) else 'SUB' end parentcircuitsourceguid",
            "case s_suppkey % 5 when 0 then '' when 1 then null else '100' end corriente",
            "nullif(s_suppkey % 7, 0) corrientemaxcortocircuito",
            "nullif(s_suppkey % 4, 0) voltaje",
            *_audit("s_suppkey"),
        ],
    ),
    "puntocarga": Adapter(
        "orders",
        [
            *_feature("o_orderkey", "o_custkey", "nullif(o_custkey % 8, 0)"),
            *_ids("o_orderkey", globalid="PC"),
            _info("o_orderkey", "nullif(o_custkey % 8, 0)"),
            "cast(o_orderkey % 7 as int) subtipo",
            "case when o_orderkey % 10 = 0 then 'PD' || cast(o_custkey % 10 as string) "
            "else 'CS' || cast(o_orderkey as string) end parentcircuitsourceguid",
            *_audit("o_orderkey"),
        ],
    ),
    "conexionconsumidor": Adapter(
        "orders",
        [
            "o_orderkey objectid",
            *_ids("o_orderkey", puntocargaglobalid="PC"),
            "case when o_custkey % 15 = 0 then null when o_custkey % 31 = 0 then '' else 'C' || cast(o_custkey as string) end "
            "codigocliente",
            "case when o_custkey % 13 = 0 then null when o_custkey % 31 = 0 then '' else 'U' || cast(o_custkey as string) end "
            "codigounico",
            "case when o_orderkey % 9 = 0 then 0.4 else o_orderkey % 3 end novedades",
            "case o_orderkey % 3 when 0 then 'FOPE' when 1 then 'OTRO' end proyectoconstruccion",
            *_audit("o_orderkey"),
        ],
    ),
    "atributosconsumidor": Adapter(
        "customer",
        [
            *_ids("c_custkey", codigocliente="C", codigounico="U"),
            "case when c_custkey % 4 = 0 then null when c_custkey % 9 = 0 then '' else 'M' || cast(c_custkey as string) end nummedidor",
            "case c_custkey % 5 when 0 then 'A' when 1 then '1' when 2 then 'W' when 3 then 'X' end edccod",
        ],
    ),
    "luminaria": Adapter(
        "events",
        [
            *_feature("event_id", "event_id", "nullif(user_id % 8, 0)"),
            _info("event_id", "nullif(user_id % 8, 0)"),
            "case when event_id % 10 = 0 then 'PD' || cast(user_id % 10 as string) "
            "else 'CS' || cast(event_id as string) end parentcircuitsourceguid",
            _order("event_id", 6),
            *_audit("event_id"),
        ],
    ),
    "alimentador": Adapter("nation", ["cast(n_nationkey as string) alimentadorid", "n_name descripcion"]),
}

# A small catalog: three layers to keep, and one of each kind to leave out.
CATALOG: dict[str, str] = {
    "fx_columns": (
        "select * from (values ('SIGELEC', 'PUESTOTRANSFDISTRIBUCION', 'ORDENTRABAJO'), "
        "('SIGELEC', 'PUESTOSECCIONADORFUSIBLE', 'ORDENTRABAJO'), ('SIGELEC', 'LUMINARIA', 'ORDENTRABAJO'), "
        "('SIGELEC', 'A12', 'ORDENTRABAJO'), ('SIGELEC', 'DUPLICADA', 'ORDENTRABAJO'), "
        "('SIGELEC', 'SINCAPA', 'ORDENTRABAJO'), ('SIGELEC', 'PUNTOCARGA', 'SUBTIPO'), "
        "('OTRO', 'AJENA', 'ORDENTRABAJO'), ('OTRO', 'DUPLICADA', 'ORDENTRABAJO')) t(owner, table_name, column_name)"
    ),
    "fx_layers": (
        "select * from (values ('PUESTOTRANSFDISTRIBUCION'), ('PUESTOSECCIONADORFUSIBLE'), ('LUMINARIA'), ('A12'), "
        "('DUPLICADA'), ('PUNTOCARGA'), ('AJENA')) t(table_name)"
    ),
}


# The star tables' columns that the adapters use. Declared, so that no job runs to infer them.
STAR_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "part": "p_partkey bigint",
    "customer": "c_custkey bigint",
    "supplier": "s_suppkey bigint",
    "events": "event_id bigint, user_id bigint",
    "nation": "n_nationkey int, n_name string",
}


def star_network(spark: SparkSession, sf_dir: str) -> Network:
    """The network over the star tables `<sf_dir>/<table>.parquet`."""
    star = cache(lambda name: spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet"))

    def load(table: str) -> DataFrame:
        adapter = ADAPTERS[table]
        return star(adapter.star).where(adapter.where).selectExpr(*adapter.columns)

    return Network(load)


def star_catalog(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tables, columns and layers of the small catalog."""
    columns, layers = [spark.sql(CATALOG[name]) for name in ("fx_columns", "fx_layers")]
    return columns.select("owner", "table_name").distinct(), columns, layers


#: Views beside the network's tables: the table behind each one. The first's name marks a table of changes, the second
#: stands in the archive too, so its name matches twice; the third has its layer's columns but stands in the archive only.
CHANGES, TWICE, ARCHIVED = "d1_luminaria", "luminaria_antigua", "puesto_retirado"
BESIDE = {CHANGES: "luminaria", TWICE: "luminaria"}
ARCHIVE = {TWICE: "luminaria", ARCHIVED: "puestotransfdistribucion"}
REGISTRY = "st_geometry_columns"
#: The column that marks a table as a layer of the map.
LAYER_COLUMN = "FASECONEXION"


def star_database(spark: SparkSession, sf_dir: str, registry_path: str) -> str:
    """The name of a catalog database with the star tables, the network's tables as views over them, and the registry of layers.

    A second database, its name with `_archive`, holds tables of another owner. The registry is a stored table that Spark
    derives from the catalog's metadata: all tables with a phase are layers.
    """
    name = f"sigelec_{sha256(sf_dir.encode()).hexdigest()[:12]}"

    def over_stars(tables: dict[str, str]) -> dict[str, str]:
        adapters = {view: ADAPTERS[table] for view, table in tables.items()}
        return {
            view: f"select {', '.join(a.columns)} from {quoted(name, a.star)} where {a.where}" for view, a in adapters.items()
        }

    stars = {star: f"{sf_dir}/{star}.parquet" for star in STAR_SCHEMAS}
    create_database(spark, name, over_stars({table: table for table in ADAPTERS} | BESIDE), stars)
    create_database(spark, f"{name}_archive", over_stars(ARCHIVE))
    columns = catalog_frames(spark, [name, f"{name}_archive"])[1]
    layers = columns.where(f"column_name = '{LAYER_COLUMN}'").select("table_name").distinct()
    layers.write.mode("overwrite").option("path", registry_path).saveAsTable(quoted(name, REGISTRY))
    return name


def star_database_layers(spark: SparkSession, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tables, columns and registered layers of both databases."""
    tables, columns = catalog_frames(spark, [name, f"{name}_archive"])
    return tables, columns, registered_layers(spark, quoted(name, REGISTRY))
