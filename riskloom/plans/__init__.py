"""End-to-end jobs over a `Lakehouse`, in the order they run."""
