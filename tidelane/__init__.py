"""tidelane: order-fulfilment and inventory analytics as Spark DataFrame operators."""

from tidelane.params import Params
from tidelane.star import Star

__all__ = ["Params", "Star"]
