"""SQL expressions for phase codes and report texts."""
