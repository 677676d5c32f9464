"""Business queries over the warehouse and the end-to-end pipeline."""
