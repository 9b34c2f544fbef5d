"""Dense tensor models: JSON layer documents -> params, read by Spark's JSON functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidescore.operators.batch_scoring import ACTIVATIONS
from tidescore.schemas import FEATURES, LAYER_TYPE, PARAMS_TYPE

DENSE_DOCUMENT = T.StructType([T.StructField("layers", T.ArrayType(LAYER_TYPE))])


def dense_params(content: Column) -> Column:
    """JSON bytes -> params struct of kind `dense`; null when the document holds no layers."""
    layers = F.from_json(content.cast("string"), DENSE_DOCUMENT)["layers"]
    fields = []
    for field in PARAMS_TYPE.fields:
        value = {"kind": F.lit("dense"), "layers": layers}.get(field.name, F.lit(None))
        fields.append(value.cast(field.dataType).alias(field.name))
    sound = (F.size(layers) > 0) & F.forall(
        layers,
        lambda l: l["bias"].isNotNull() & l["weights"].isNotNull() & (F.size(l["bias"]) == F.size(l["weights"])),
    )
    return F.when(sound, F.struct(*fields))


def fitting_layers(layers: Column) -> Column:
    """Whether layers plainly score a record: known activations, all numbers there, every layer as wide as the one before.

    Where this is true `trial` finds nothing wrong; where it is not, the trial decides.
    """
    def fits(width: Column, layer: Column) -> Column:
        weights, bias = layer["weights"], layer["bias"]
        row = lambda w: w.isNotNull() & (F.size(w) == width) & ~F.exists(w, lambda x: x.isNull())
        sound = (F.coalesce(layer["activation"], F.lit("identity")).isin(*ACTIVATIONS) & (F.size(weights) > 0)
                 & (F.size(weights) == F.size(bias)) & ~F.exists(bias, lambda x: x.isNull()) & F.forall(weights, row))
        return F.when(sound, F.size(weights)).otherwise(F.lit(-1))

    return F.coalesce((F.size(layers) > 0) & (F.aggregate(layers, F.lit(len(FEATURES)), fits) > 0), F.lit(False))
