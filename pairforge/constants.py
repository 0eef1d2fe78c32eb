"""Fixed values.

These strings and numbers must equal the reference pipeline's for byte-identical prompts,
provenance stamps and splits.  They are stated once here, in natural order.
"""

# ---- fixed values: model identifiers and provenance -------------------------------------
# The fine-tuned model is whatever the user trained; its id is a caller-supplied stamp.
SFT_MODEL_ID = "sft-model"
BASE_MODEL_ID = "gpt2"
JUDGE_PROMPT_VERSION = "v3-transformers-teacher"
DEFAULT_JUDGE_MODEL = "Qwen/Qwen2.5-7B-Instruct"

# ---- fixed values: seeds, fractions, sizes ----------------------------------------------
SPLIT_SEED = 42
SPLIT_FRACTION = 0.05
DEFAULT_SEED = 42
NUM_SAMPLES = 4
GEN_BATCH_SIZE = 8
PROMPT_TOKEN_CAP = 512
SFT_MAX_LENGTH = 1024
IGNORE_INDEX = -100
RANK_MAX_NEW_TOKENS = 128
GEN_MAX_NEW_TOKENS = 512

# ---- fixed values: templates --------------------------------------------------------------
HUMAN_PREFIX = "Human: "
ASSISTANT_PREFIX = "Assistant:"
EOS_TEXT = "<|endoftext|>"

# ---- fixed values: rank prompt for picking the best of several candidates ---------------
RANK_SYSTEM = """You are an expert evaluator for instruction-following assistants.
Given a user instruction and several candidate assistant responses, pick the single BEST response.

Judge on:
1. Correctness and factual accuracy
2. Following the instruction
3. Helpfulness and clarity

Respond with ONLY valid JSON in this exact format:
{"best": <1-based index>, "reason": "<one sentence>"}"""

# ---- fixed values: the two literal replacements that turn it into a best/worst prompt ----
BEST_WORST_REPLACEMENTS = (
    ("pick the single BEST response", "pick the BEST and WORST response"),
    (
        '{"best": <1-based index>, "reason": "<one sentence>"}',
        '{"best": <1-based index>, "worst": <1-based index>, "reason": "<one sentence>"}'
        "\n\nbest and worst must be different indices.",
    ),
)

# ---- fixed values: teacher system prompt ---------------------------------------------------
TEACHER_SYSTEM = "You are a helpful assistant. Answer the user's instruction clearly and accurately."

# ---- fixed values: blind three-way ranking prompt -----------------------------------------
BLIND_RANK_SYSTEM = """You are an expert evaluator for instruction-following assistants.
Given a user instruction and three anonymous candidate assistant responses, rank them from best to worst.

Judge on:
1. Correctness and factual accuracy
2. Following the instruction
3. Helpfulness and clarity

Do not assume anything about how the responses were produced. Evaluate only the text.

Respond with ONLY valid JSON in this exact format:
{"ranking": [best_index, second_index, worst_index], "reason": "<one sentence>"}

Use each of 1, 2, 3 exactly once in the ranking list."""

# ---- fixed values: prompt skeleton pieces ---------------------------------------------------
INSTRUCTION_HEADER = "Instruction:\n"
CANDIDATES_HEADER = "Candidate responses:"
RETURN_JSON = "\nReturn JSON only."
INPUT_JOIN = "\n\nInput: "

# ---- fixed values: pair provenance --------------------------------------------------------
MODE_TEACHER = "teacher"
MODE_BEST_WORST = "rank_best_worst"
SOURCE_TEACHER = "teacher_generation"
SOURCE_BEST = "best_sft_of_4"
SOURCE_WORST = "worst_sft_of_4"

# ---- fixed values: evaluated systems (label map values) ----------------------------------
SYSTEMS = ("pretrained", "sft", "dpo")

# ---- fixed values: artifacts ----------------------------------------------------------------
ADAPTER_CONFIG = "adapter_config.json"
ADAPTER_WEIGHTS = "adapter_model.safetensors"
EXPORT_EXCLUDE = ("optimizer.pt", "scheduler.pt", "rng_state.pth", "trainer_state.json", "training_args.bin")
POLL_INTERVAL_SEC = 300
QUIET_PERIOD_SEC = 120
