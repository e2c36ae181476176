"""Sources: change logs, chunk streams, snapshots, SQL files, catalogs and configuration."""
