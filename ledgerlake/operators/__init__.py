"""DataFrame -> DataFrame operators. Pure, lazy, no actions unless documented."""
