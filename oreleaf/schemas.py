"""Record types of the extraction schemas and the registry that drives every operator.

Adding a schema means adding one :class:`ExtractionSchema`: validation, flattening,
consolidation and output are generated from it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from oreleaf import templates


def _struct(**fields: str | T.DataType) -> T.StructType:
    kinds = {
        "int": T.IntegerType(), "float": T.DoubleType(), "bool": T.BooleanType(),
        "str": T.StringType(), "list": T.ArrayType(T.StringType(), True),
    }
    return T.StructType([T.StructField(n, kinds.get(t, t) if isinstance(t, str) else t) for n, t in fields.items()])


# Field names and types of the three record schemas, and the column
# order of their flat outputs. They are the contract with downstream readers.

STUDY = _struct(year="int", doi="str", title="str")

ADSORPTION_SYNTHESIS = _struct(
    method_name="list", metal_precursors="list", temperature="float", temperature_units="str",
    ph="float", aging_time_hr="float", exfoliation="bool", calcination_temp_c="float")

ADSORPTION_PROPERTIES = _struct(
    m2_metals_doping="list", m2_metals_ratios="list", m3_metals_ratios="list", m2_m3_ratio="float",
    anions="list", impregnation="bool", impregnation_compound="str")

ADSORPTION_MEASUREMENT = _struct(
    adsorption_temperature_c="float", pressure_bar="float", gas_composition="str", wet_dry_air="bool",
    co2_adsorption_capacity_mmol_g="float")

CATALYST_SYNTHESIS = _struct(
    method_name="list", metal_precursors="list", temperature="float", temperature_units="str",
    ph="float", aging_time_hr="float", exfoliation="bool", calcination_temp="float",
    calcination_temp_units="str", reduction_pretreatment="str")

CATALYST_COMPOSITION = _struct(
    m2_metals_doping="list", m2_metals_ratios="list", m3_metals_ratios="list", m2_m3_ratio="float", anions="list")

CATALYST_PERFORMANCE = _struct(
    reaction_type="str", temperature="float", temperature_units="str", pressure="float", pressure_units="str",
    feed_composition="str", co2_conversion="float", co_selectivity="float", ch4_selectivity="float",
    methanol_selectivity="float")

ADSORPTION_RECORD = _struct(
    material_id="str", study_metadata=STUDY, synthesis_method=ADSORPTION_SYNTHESIS,
    material_properties=ADSORPTION_PROPERTIES, measurement=ADSORPTION_MEASUREMENT)

CATALYST_RECORD = _struct(
    material_id="str", study_metadata=STUDY, synthesis_conditions=CATALYST_SYNTHESIS,
    metal_composition=CATALYST_COMPOSITION, performance=CATALYST_PERFORMANCE)

USECASE_RECORD = _struct(
    material_id="str", study_metadata=STUDY, synthesis_method=ADSORPTION_SYNTHESIS,
    material_properties=ADSORPTION_PROPERTIES, use_cases="list")

_SYNTHESIS_RENAMES = {
    "method_name": "synthesis_method",
    "temperature": "synthesis_temperature",
    "temperature_units": "synthesis_temperature_units",
}


@dataclass(frozen=True)
class ExtractionSchema:
    """One record schema and what the operators need to know about it."""

    name: str
    record: T.StructType
    # list fields for which a bare string stands for a one-item list
    scalar_or_list: frozenset[str]
    # records equal in all of these fields are variants of one record
    key: tuple[str, ...]
    # material and condition: what a verification must not change
    identity: tuple[str, ...]
    extract_prompt: str
    verify_prompt: str
    batch_prompt: str
    # flat names that differ from the leaf's own name
    renames: dict[str, str] = field(default_factory=dict)
    # list fields united over the variants instead of taken from the best one
    united: tuple[str, ...] = ()

    @property
    def count_key(self) -> str:
        return f"n_{self.name}_materials"

    def leaves(self) -> list[tuple[str, T.DataType]]:
        """(dotted path, type) of every scalar and list field, in record order."""
        out = []
        for f in self.record.fields:
            if isinstance(f.dataType, T.StructType):
                out += [(f"{f.name}.{c.name}", c.dataType) for c in f.dataType.fields]
            else:
                out.append((f.name, f.dataType))
        return out

    @property
    def flat(self) -> list[tuple[str, str]]:
        """(flat column, dotted path) in output order."""
        return [(self.renames.get(path, path.rsplit(".", 1)[-1]), path) for path, _ in self.leaves()]

    @property
    def fieldnames(self) -> list[str]:
        return [name for name, _ in self.flat]


def _synthesis(prefix: str) -> dict[str, str]:
    return {f"{prefix}.{leaf}": flat for leaf, flat in _SYNTHESIS_RENAMES.items()}


CATALYST = ExtractionSchema(
    name="catalyst",
    record=CATALYST_RECORD,
    scalar_or_list=frozenset({"synthesis_conditions.method_name"}),
    key=(
        "material_id", "metal_composition.m2_metals_doping", "metal_composition.m2_metals_ratios",
        "metal_composition.m3_metals_ratios", "metal_composition.m2_m3_ratio", "metal_composition.anions",
        "performance.reaction_type", "performance.temperature", "performance.temperature_units",
        "performance.pressure", "performance.pressure_units", "performance.feed_composition",
        "performance.co2_conversion", "performance.co_selectivity", "performance.ch4_selectivity",
        "performance.methanol_selectivity",
    ),
    identity=(
        "material_id", "performance.temperature", "performance.temperature_units", "performance.pressure",
        "performance.pressure_units", "performance.feed_composition",
    ),
    extract_prompt=templates.EXTRACT["catalyst"],
    verify_prompt=templates.VERIFY["catalyst"],
    batch_prompt=templates.BATCH["catalyst"],
    renames=_synthesis("synthesis_conditions"),
)

ADSORPTION = ExtractionSchema(
    name="adsorption",
    record=ADSORPTION_RECORD,
    scalar_or_list=frozenset({"synthesis_method.method_name"}),
    key=(
        "material_id", "material_properties.m2_metals_doping", "material_properties.m2_metals_ratios",
        "material_properties.m3_metals_ratios", "material_properties.m2_m3_ratio", "material_properties.anions",
        "material_properties.impregnation", "material_properties.impregnation_compound",
        "measurement.adsorption_temperature_c", "measurement.pressure_bar", "measurement.gas_composition",
        "measurement.wet_dry_air", "measurement.co2_adsorption_capacity_mmol_g",
    ),
    identity=(
        "material_id", "measurement.adsorption_temperature_c", "measurement.pressure_bar",
        "measurement.gas_composition", "measurement.wet_dry_air",
    ),
    extract_prompt=templates.EXTRACT["adsorption"],
    verify_prompt=templates.VERIFY["adsorption"],
    batch_prompt=templates.BATCH["adsorption"],
    renames=_synthesis("synthesis_method"),
)

USECASE = ExtractionSchema(
    name="usecase",
    record=USECASE_RECORD,
    scalar_or_list=frozenset({"synthesis_method.method_name", "use_cases"}),
    key=(
        "material_id", "material_properties.m2_metals_doping", "material_properties.m2_metals_ratios",
        "material_properties.m3_metals_ratios", "material_properties.m2_m3_ratio", "material_properties.anions",
        "material_properties.impregnation", "material_properties.impregnation_compound",
    ),
    identity=("material_id",),
    extract_prompt=templates.EXTRACT["usecase"],
    verify_prompt=templates.VERIFY["usecase"],
    batch_prompt=templates.BATCH["usecase"],
    renames=_synthesis("synthesis_method"),
    united=("use_cases",),
)

SCHEMAS: dict[str, ExtractionSchema] = {s.name: s for s in (CATALYST, ADSORPTION, USECASE)}
SCHEMA_NAMES = [*SCHEMAS]


def select_schemas(names: list[str] | None = None) -> list[ExtractionSchema]:
    """The named schemas without repeats, in the order given; all when none are named."""
    unknown = [n for n in names or [] if n not in SCHEMAS]
    if unknown:
        raise ValueError(f"unknown schema {unknown[0]!r}; expected one of {', '.join(SCHEMAS)}")
    return [SCHEMAS[n] for n in dict.fromkeys(names or SCHEMA_NAMES)]
