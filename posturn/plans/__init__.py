"""End-to-end plans: the batch pipeline and the driver query registry."""
