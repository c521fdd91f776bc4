"""Rule tables as rows, and the columns that come with each rule."""

from __future__ import annotations

# The rows of the published rule tables, in their order.

#: Ability layer and the phrases that choose it (CLS-1).
ROUTES = [
    ("思维分析", "帮我分析|如何决策|怎么拆解|帮我判断|怎么选"),
    ("笔记处理", "整理笔记|会议纪要|知识结晶"),
    ("公众号创作", "写公众号|检查草稿|取标题"),
]
#: Writing mode, the phrases that choose it, and what it delivers (CLS-2).
WRITING_MODES = [
    ("选题诊断", "这个题能不能写|值不值得写", "选题判断 + 角度建议"),
    ("提纲设计", "先帮我搭结构|给我大纲", "标题方向 + 提纲"),
    ("成稿起草", "帮我写一篇", "完整初稿"),
    ("改写增强", "这篇太 AI 了|帮我改顺", "重写稿 + 修改说明"),
    ("草稿质检", "检查下问题", "质检报告 + 修复建议"),
    ("标题排版", "给我标题|排一下版", "标题组 / 排版稿"),
]
#: What is missing, main tools, supporting chain, and what the output dwells on (CLS-4).
GAPS = [
    ("对象和问题不清", "问题链思维、抽象建模", "课题分离、第一性原理、批判性思维", "定义、边界、关键变量、待验证假设"),
    ("要不要做、该怎么选", "问题链思维、选择三问", "财务报表、供需与边际调节、不可能三角", "该不该、能不能、爱不爱，最坏结果能否承受"),
    ("人和组织行为难以解释", "利益-成本-信仰、系统性思考", "供需与边际调节、课题分离、社会网络", "谁获益/受损，谁承担成本，是否存在底线、身份或关系约束"),
    ("变量关系和时间变化", "抽象建模与函数化思维、函数化分析", "构建统计量、数据分析、贝叶斯更新", "横轴纵轴、曲线阶段、指标口径、趋势判断"),
    ("系统为何反复产生同一结果", "系统性思考、输入输出分析", "因果分析、主要矛盾分析、生理学或脑科学视角", "系统边界、反馈回路、输入输出、主要矛盾"),
    ("价格、收入、机会和定价权", "供需与边际调节思维", "财务报表、折现值、杠杆、不可能三角", "供需失衡、边际变量、价格/条件/行为路径"),
    ("价值能否被别人选择", "供需与边际调节思维、语言表达视角", "营销学、人类学、信息压缩", "需求层次、心智位置、表达结构、传播阻力"),
    ("风险、现金流和长期下注", "财务报表分析、折现值分析、投资哲学", "贝叶斯更新、杠杆、不可能三角、处境校正", "基本盘、现金流、下行风险、非对称机会"),
    ("方向有了但做不出来", "工程化思维、模块化拆解", "构建统计量、OKR、清单、时间表、主要矛盾", "交付物、模块、最小抓手、验证指标"),
    ("事情已经发生，需要沉淀", "复盘、数据分析", "因果分析、构建统计量、贝叶斯更新、系统性思考", "事实还原、变量、模型、边界、下一轮验证"),
    ("学习、情绪、习惯、自控失灵", "输入输出分析、脑科学/生理学视角", "系统性思考、工程化思维、心理学视角", "底层状态、机制层级、最小闭环、恢复路径"),
    ("信息太多或表达无效", "语言表达视角、信息论原则", "问题链思维、认知心理学、供需匹配子系统", "中心、层级、顺序、事实故事、必要冗余"),
]
#: Question signal as a pattern, first candidates, and what to ask next (CLS-5).
QUESTION_SIGNALS = [
    ("我不知道问题是什么", "问题链、抽象建模、课题分离", "对象是什么，边界在哪里，谁承担后果"),
    ("它为什么总是这样", "系统性思考、因果分析、主要矛盾", "哪些变量互相增强，哪个变量牵动最多下游"),
    ("它未来会怎么变", "函数化分析、构建统计量、贝叶斯更新", "变量关系是什么，处在哪条曲线，证据质量如何"),
    ("为什么它值钱|为什么它不值钱", "供需与边际调节思维、折现值", "需求是否真实，供给是否稀缺，边际变量是谁"),
    ("我该不该投|我该不该去|我该不该做", "财务报表、折现值、供需与边际调节、不可能三角", "下行是否可承受，现金流能否撑到兑现，放弃什么"),
    ("我知道但做不出来", "工程化思维、模块化拆解、输入输出", "交付物是什么，最小抓手在哪里，底层状态是否可用"),
    ("别人为什么不理解|别人为什么不选择", "供需与边际调节思维、语言表达、信息压缩", "对方需求是什么，中心是否清楚，心智位置在哪里"),
    ("这次经历说明什么", "复盘、数据分析、因果、贝叶斯", "原假设是什么，偏差在哪里，下一次验证什么"),
    ("我状态不好|失控|拖延", "输入输出、脑科学、生理学、心理学", "输入是否劣化，身体是否过载，行为在保护什么"),
    ("这个社会为什么这样|行业为什么这样", "供需与边际调节思维、社会网络、历史、复杂性科学", "结构位置如何，长期周期如何，是否存在涌现和共识"),
]
#: Article archetype and the marks of its material (CLS-3).
ARCHETYPES = [
    ("调查实验型", "亲历|实测|调查|实验"),
    ("产品体验型", "产品|体验"),
    ("现象解读型", "社会现象|行业变化|热点|争议"),
    ("工具分享型", "具体工具|工具|插件"),
    ("方法论分享型", "经验|心得|框架|方法论"),
]
#: Primitive type and its examples (CLS-9).
PRIMITIVES = [
    ("object", "customer|payment method|document|task|identity|asset|claim|source|entity"),
    ("action", "send|verify|charge|classify|extract|rank|reconcile|deploy|monitor"),
    ("data", "canonical dataset|index|normalized feed|enriched profile|event stream|ground-truth table"),
    ("rule", "policy engine|permission model|validation rule|compliance check|scoring rubric"),
    ("protocol", "schema|message format|command contract|integration spec|workflow handshake"),
    ("capability", "email delivery|browser automation|ocr|fraud detection|search|retrieval|deployment"),
    ("agent", "tool schema|callable action|memory operation|evaluation harness|planner/executor boundary|observable environment action"),
]
#: Kind of macro information, its typical content, and what it settles (CLS-16).
MACRO_KINDS = [
    ("观察角度", "周期|三流体系|供需|总量与结构", "用什么镜头看"),
    ("历史脉络", "中国增长模式|红利切换|转型约束", "为什么中国要这样看"),
    ("分析对象", "增长|通胀|政策|流动性", "核心变量怎么拆"),
    ("跟踪方法", "指标体系|快指标|高频验证|政策时间窗口", "平时拿什么跟"),
    ("延伸解释", "定义|公式|口径|使用边界|误区", "某个对象具体怎么用"),
]
#: Kind of claim and its first-hand source (CLS-20).
FIRST_HAND = [("policy", "issuing body"), ("company notice", "company newsroom"), ("academic claim", "paper or institution"), ("tool usage", "official documentation or source")]
