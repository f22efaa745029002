"""Landing files, staged tables and warehouse tables."""
