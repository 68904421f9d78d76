from salesmart.operators.lookup import BROADCAST_ROWS, attach_key
from salesmart.operators.representative import representative
from salesmart.operators.surrogate import dense_id, position_id, ranked_id

__all__ = ["BROADCAST_ROWS", "attach_key", "dense_id", "position_id", "ranked_id", "representative"]
