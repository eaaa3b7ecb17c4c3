"""The pipeline's steps: packing, inventory, bronze, silver, gold, quality."""
