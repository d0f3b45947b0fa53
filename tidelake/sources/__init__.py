"""Where metadata and data come from: catalog connections, catalog reads, paths, types, the data source."""
