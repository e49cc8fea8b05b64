"""Named queries over tables, each with its equivalent in SQL."""
