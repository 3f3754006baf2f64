"""Float-shaped views over the driver's tables, and the queries run on them."""
