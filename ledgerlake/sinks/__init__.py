"""Writers for every layer, with row counts observed during the write."""
